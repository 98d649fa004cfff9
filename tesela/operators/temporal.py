"""Temporal analytics over resolved ratings: classes, the daily cube, salience, levels and volumes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..functions.time import Period, local_day, period_of, utc

NO_LANG = "(sin idioma)"
CUBE = ["fecha", "slug", "clase", "nivel", "idioma", "autosuficiente"]


def first_of_each(corpus: DataFrame, id_col: str, keep: Sequence[str], seq: str | None = None) -> DataFrame:
    """The corpus with one row per stripped id: the first by seq, or the least of the kept columns without one."""
    row = F.struct(*keep)
    order = F.col(seq) if seq else row
    one = corpus.groupBy(strip(F.col(id_col).cast("string")).alias("tweet_id")).agg(F.min_by(row, order).alias("c"))
    return one.select("tweet_id", *[F.col(f"c.{c}").alias(c) for c in keep])


def orphans(ratings: DataFrame, corpus: DataFrame, id_col: str = "id") -> DataFrame:
    """tweet_ids of ratings that the corpus lacks."""
    ids = corpus.select(strip(F.col(id_col).cast("string")).alias("tweet_id"))
    return ratings.select("tweet_id").distinct().join(ids, "tweet_id", "left_anti")


def clase(absence: dict[str, Sequence[str]]) -> Column:
    """valencia, ausencia or fallida; absence has each criterion's levels that mean absence."""
    pairs = [(s, level) for s, levels in absence.items() for level in levels]
    absent = F.lit(False)
    for s, level in pairs:
        absent = absent | ((F.col("slug") == s) & (F.col("nivel") == level))
    is_ok = F.col("estado") == "OK"
    return F.when(is_ok & F.coalesce(absent, F.lit(False)), "ausencia").when(is_ok, "valencia").when(F.col("estado") == "NO_APLICABLE", "ausencia").otherwise("fallida")


def prepare(ratings: DataFrame, corpus: DataFrame, ts_col: str, zone: str, periods: Sequence[Period], id_col: str = "id", lang_col: str = "lang", ts_in_corpus: bool = True, seq: str | None = None) -> DataFrame:
    """Ratings of the corpus's tweets with dia (local date), fecha (its text), idioma, autosuficiente and periodo. Only the
    needed columns of the corpus are read."""
    keep = [lang_col, *([ts_col] if ts_in_corpus else [])]
    one = first_of_each(corpus, id_col, keep, seq)
    rated = ratings.withColumn("tweet_id", strip(F.col("tweet_id")))
    rated = rated.drop(*[c for c in keep if c in rated.columns])
    joined = rated.join(one, "tweet_id")
    day = local_day(utc(F.col(ts_col)), zone)
    lang = F.coalesce(F.nullif(strip(F.col(lang_col)), F.lit("")), F.lit(NO_LANG))
    out = joined.withColumn("dia", day).where(F.col("dia").isNotNull())
    return out.withColumns({"fecha": F.date_format("dia", "yyyy-MM-dd"), "idioma": lang, "autosuficiente": F.coalesce("contexto_incompleto", F.lit("")) == "", "periodo": period_of(F.col("dia"), periods)})


def prepare_report(ready: DataFrame, ratings: DataFrame, corpus: DataFrame, umbral: int = 30, id_col: str = "id") -> DataFrame:
    """One row: ratings, tweets, days, first and last day, share of incomplete context and ratings outside all periods of ready; tweets a day,
    and whether they are too few; ratings and tweets that the corpus lacks, whether it lacks all, and ratings of unreadable dates."""
    ids = corpus.select(strip(F.col(id_col).cast("string")).alias("__id")).distinct()
    rated = ratings.select(strip(F.col("tweet_id")).alias("tweet_id"))
    lacking = F.col("__id").isNull()
    seen = rated.join(ids, rated["tweet_id"] == ids["__id"], "left").agg(
        F.count("*").alias("all"), F.countDistinct("tweet_id").alias("tweets"), F.count_if(lacking).alias("orphans"), F.countDistinct(F.when(lacking, F.col("tweet_id"))).alias("orphan_tweets")
    )
    g = ready.agg(
        F.count("*").alias("ratings"), F.countDistinct("tweet_id").alias("tweets"), F.countDistinct("dia").alias("days"), F.min("fecha").alias("first_day"), F.max("fecha").alias("last_day"),
        F.round(F.count_if(~F.col("autosuficiente")) / F.greatest(F.count("*"), F.lit(1)), 6).alias("incomplete"), F.count_if(F.col("periodo").isNull()).alias("outside"),
    )
    g = g.withColumn("__s", seen.select(F.struct("*").alias("s")).scalar())
    per_day = F.col("tweets") / F.greatest("days", F.lit(1))
    return g.select(
        "ratings", "tweets", "days", "first_day", "last_day", "incomplete", "outside", F.round(per_day, 1).alias("per_day"), (per_day < umbral).alias("low_coverage"),
        F.col("__s.orphans").alias("orphans"), F.col("__s.orphan_tweets").alias("orphan_tweets"), ((F.col("__s.orphan_tweets") > 0) & (F.col("__s.orphan_tweets") == F.col("__s.tweets"))).alias("no_match"),
        (F.col("__s.all") - F.col("__s.orphans") - F.col("ratings")).alias("unreadable"),
    )


def cube(ready: DataFrame, absence: dict[str, Sequence[str]]) -> DataFrame:
    """n by fecha, slug, clase, nivel (only of valencia), idioma, autosuficiente."""
    c = ready.withColumn("clase", clase(absence))
    level = F.when(F.col("clase") == "valencia", F.coalesce("nivel", F.lit(""))).otherwise("")
    return c.withColumn("nivel", level).groupBy(*CUBE).agg(F.count("*").alias("n"))


def volume(ready: DataFrame) -> DataFrame:
    """Distinct tweets by day, language and self-sufficiency."""
    keys = ["fecha", "idioma", "autosuficiente"]
    return ready.select("tweet_id", *keys).distinct().groupBy(*keys).agg(F.count("*").alias("n"))


def languages(ready: DataFrame) -> DataFrame:
    return ready.groupBy("idioma").agg(F.countDistinct("tweet_id").alias("tweets")).orderBy(F.desc("tweets"), "idioma")


def by_period(ready: DataFrame, periods: Sequence[Period]) -> DataFrame:
    """Days, tweets and tweets per day of every period, 0 where there are none."""
    names = ready.sparkSession.createDataFrame([(p.name,) for p in periods], "periodo string")
    g = ready.where("periodo IS NOT NULL").groupBy("periodo").agg(F.countDistinct("fecha").alias("days"), F.countDistinct("tweet_id").alias("tweets"))
    full = names.join(g, "periodo", "left").select("periodo", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("days", "tweets")])
    return full.withColumn("per_day", F.round(F.col("tweets") / F.greatest("days", F.lit(1)), 1))


def class_totals(c: DataFrame) -> DataFrame:
    """Counts and shares of the classes for each criterion."""
    g = c.groupBy("slug").agg(*[F.sum(F.when(F.col("clase") == k, F.col("n")).otherwise(0)).alias(k) for k in ("valencia", "ausencia", "fallida")], F.sum("n").alias("total"))
    return g.select("*", *[F.round(F.col(k) / F.greatest("total", F.lit(1)), 6).alias(f"share_{k}") for k in ("valencia", "ausencia", "fallida")])


def dates(c: DataFrame) -> DataFrame:
    return c.select("fecha").distinct().orderBy("fecha")


def chosen(c: DataFrame, langs: Sequence[str] | None = None, only_self_sufficient: bool = False) -> DataFrame:
    """The charts' predicate."""
    c = c.where(F.col("idioma").isin(*langs)) if langs is not None else c
    return c.where("autosuficiente") if only_self_sufficient else c


def daily(c: DataFrame, levels: dict[str, Sequence[str]]) -> DataFrame:
    """fecha, slug, con_valencia, ausencia, fallida. Valence of a level that the rubric lacks counts as failed."""
    known = F.lit(False)
    for s, names in levels.items():
        known = known | ((F.col("slug") == s) & F.col("nivel").isin(*names))
    value = (F.col("clase") == "valencia") & known
    total = lambda p: F.coalesce(F.sum(F.when(p, F.col("n"))), F.lit(0)).cast("long")
    failed = (F.col("clase") == "fallida") | ((F.col("clase") == "valencia") & ~known)
    return c.groupBy("fecha", "slug").agg(total(value).alias("con_valencia"), total(F.col("clase") == "ausencia").alias("ausencia"), total(failed).alias("fallida"))


def salience(d: DataFrame) -> DataFrame:
    """Share of days' valence in valence and absence; null without either."""
    base = F.col("con_valencia") + F.col("ausencia")
    return d.select("fecha", "slug", "con_valencia", base.alias("base"), F.round(F.try_divide("con_valencia", base), 6).alias("salience"))


def smoothed(s: DataFrame, window: int = 7, value: str = "salience") -> DataFrame:
    """A centred mean of the observed dates around each, nulls left out. A criterion's missing dates count as places."""
    grid = s.select("fecha").distinct().crossJoin(F.broadcast(s.select("slug").distinct()))  # a few criteria, each date once
    full = grid.join(s.select("fecha", "slug", value), ["fecha", "slug"], "left")
    half = window // 2
    w = Window.partitionBy("slug").orderBy("fecha").rowsBetween(-half, half)
    return full.withColumn("smoothed", F.round(F.avg(value).over(w), 6))


def daily_levels(c: DataFrame, levels: dict[str, Sequence[str]]) -> DataFrame:
    """fecha, slug, nivel, n, share of the day's valence for every date and every level of the rubric. A day on which a criterion has
    nothing is null and not 0; so is the share of a day without valence."""
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("slug"), F.lit(x).alias("nivel")) for s, names in levels.items() for x in names])).alias("l")
    grid = c.select("fecha").distinct().select("fecha", each).select("fecha", "l.slug", "l.nivel")
    g = c.groupBy("fecha", "slug", F.when(F.col("clase") == "valencia", F.col("nivel")).alias("nivel")).agg(F.sum("n").alias("n"))
    some = g.select("fecha", "slug").distinct().withColumn("__some", F.lit(True))
    full = grid.join(g, ["fecha", "slug", "nivel"], "left").join(some, ["fecha", "slug"], "left")
    full = full.withColumn("n", F.when(F.col("__some"), F.coalesce("n", F.lit(0))).cast("long")).drop("__some")
    total = F.sum("n").over(Window.partitionBy("fecha", "slug"))
    return full.withColumn("share", F.round(F.try_divide("n", total), 6))


def level_distribution(c: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """n and share of each level of a criterion, over all or by further columns."""
    keys = [*by, "slug"]
    g = c.where("clase = 'valencia'").groupBy(*keys, "nivel").agg(F.sum("n").alias("n"))
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(*keys)), 6))


def period_distribution(c: DataFrame, periods: Sequence[Period], levels: dict[str, Sequence[str]]) -> DataFrame:
    """periodo, slug, nivel, n, share for every period and level of the rubric; 0 where there is none."""
    dated = c.withColumn("periodo", period_of(F.to_date("fecha"), periods)).where("periodo IS NOT NULL AND clase = 'valencia'")
    g = dated.groupBy("periodo", "slug", "nivel").agg(F.sum("n").alias("n"))
    frame = c.sparkSession.createDataFrame([(p.name, s, x) for p in periods for s, names in levels.items() for x in names], "periodo string, slug string, nivel string")
    full = frame.join(g, ["periodo", "slug", "nivel"], "left")
    n = F.coalesce("n", F.lit(0)).cast("long")
    full = full.withColumn("n", n)
    total = F.sum("n").over(Window.partitionBy("periodo", "slug"))
    return full.withColumn("share", F.coalesce(F.round(F.try_divide("n", total), 6), F.lit(0.0)))


def volume_by_language(v: DataFrame, langs: Sequence[str]) -> DataFrame:
    """A column of tweets for each language; the languages are given, so no extra job finds them."""
    return v.groupBy("fecha").pivot("idioma", list(langs)).agg(F.sum("n")).na.fill(0)


def small_sample(v: DataFrame, threshold: int) -> DataFrame:
    return v.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("tweets")).withColumn("small", F.col("tweets") < threshold)
