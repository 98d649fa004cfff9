"""Quality statistics over resolved logs: distribution, test-retest, models and a gold standard."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip


def distribution(resolved: DataFrame, levels: DataFrame, top_alert: float = 0.90, absent_alert: float = 0.50) -> DataFrame:
    """slug, nivel, n, share among levels, top_share, na_share, alert for every level of the rubric, zero ones too."""
    by = resolved.groupBy("slug").agg(F.count("*").alias("total"), F.count_if(F.col("estado") == "OK").alias("ok"), F.count_if(F.col("estado") == "NO_APLICABLE").alias("na"))
    n = resolved.where("estado = 'OK'").groupBy("slug", "nivel").agg(F.count("*").alias("n"))
    full = levels.select("slug", "nivel")
    g = full.join(n, ["slug", "nivel"], "left").join(by, "slug", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    ok, total = F.greatest(F.coalesce("ok", F.lit(0)), F.lit(1)), F.greatest(F.coalesce("total", F.lit(0)), F.lit(1))
    top = F.max("n").over(Window.partitionBy("slug")) / ok
    g = g.withColumns({"share": F.round(F.col("n") / ok, 6), "top_share": F.round(top, 6), "na_share": F.round(F.coalesce("na", F.lit(0)) / total, 6)})
    return g.select("slug", "nivel", "n", "share", "top_share", "na_share", ((F.col("top_share") > top_alert) | (F.col("na_share") > absent_alert)).alias("alert"))


def failure_reasons(resolved: DataFrame) -> DataFrame:
    return resolved.where("estado NOT IN ('OK', 'NO_APLICABLE')").groupBy("slug", "estado").agg(F.count("*").alias("n"))


def _both(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("tweet_id", "slug", F.col("nivel").alias("a")).join(b.select("tweet_id", "slug", F.col("nivel").alias("b")), ["tweet_id", "slug"])


def retest(a: DataFrame, b: DataFrame, threshold: float = 0.95) -> DataFrame:
    """n and agreement for each criterion, and for all ("(global)", weighted by n) from the same aggregation."""
    g = _both(a, b).groupBy("slug").agg(F.count("*").alias("n"), F.count_if(F.col("a").eqNullSafe(F.col("b"))).alias("same"))
    every = g.agg(F.lit("(global)").alias("slug"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"), F.coalesce(F.sum("same"), F.lit(0)).cast("long").alias("same"))
    out = g.unionByName(every).withColumn("agreement", F.round(F.try_divide("same", "n"), 6))
    return out.select("slug", "n", "agreement", (F.col("agreement") >= threshold).alias("stable"))


def inter_model(a: DataFrame, b: DataFrame, levels: DataFrame, unstable: float = 0.6) -> DataFrame:
    """Exact agreement and agreement within one step of the scale; a missing level is not within one."""
    dim = F.broadcast(levels.select("slug", "nivel", "ordinal"))  # the rubric: some dozens of rows
    j = _both(a, b)
    j = j.join(dim.select(F.col("slug").alias("__s"), F.col("nivel").alias("__l"), F.col("ordinal").alias("oa")), (F.col("slug") == F.col("__s")) & (F.col("a") == F.col("__l")), "left").drop("__s", "__l")
    j = j.join(dim.select(F.col("slug").alias("__s"), F.col("nivel").alias("__l"), F.col("ordinal").alias("ob")), (F.col("slug") == F.col("__s")) & (F.col("b") == F.col("__l")), "left").drop("__s", "__l")
    near = F.coalesce(F.abs(F.col("oa") - F.col("ob")) <= 1, F.lit(False))
    g = j.groupBy("slug").agg(F.count("*").alias("n"), F.round(F.avg(F.col("a").eqNullSafe(F.col("b")).cast("int")), 6).alias("exact"), F.round(F.avg(near.cast("int")), 6).alias("within_one"))
    return g.withColumn("unstable", F.col("exact") < unstable)


def _gold(resolved: DataFrame, gold: DataFrame) -> DataFrame:
    g = gold.where(strip(F.coalesce("nivel_humano", F.lit(""))) != "").select("tweet_id", "slug", strip(F.col("nivel_humano")).alias("humano"))
    return resolved.select("tweet_id", "slug", "nivel").join(g, ["tweet_id", "slug"]).withColumn("same", F.coalesce(F.col("nivel") == F.col("humano"), F.lit(False)))


def gold_agreement(resolved: DataFrame, gold: DataFrame, ok: float = 0.7) -> DataFrame:
    g = _gold(resolved, gold).groupBy("slug").agg(F.count("*").alias("n"), F.round(F.avg(F.col("same").cast("int")), 6).alias("agreement"))
    return g.withColumn("ok", F.col("agreement") >= ok)


def gold_disagreements(resolved: DataFrame, gold: DataFrame, k: int = 15) -> DataFrame:
    return _gold(resolved, gold).where("NOT same").select("tweet_id", "slug", "humano", "nivel").orderBy("slug", "tweet_id").limit(k)


def gold_template(sample: DataFrame, criteria: DataFrame, id_col: str = "id", text_col: str = "text_completo") -> DataFrame:
    """A sheet to annotate: each sampled row with each criterion. The criteria are the rubric's."""
    rows = sample.select(F.col(id_col).cast("string").alias("tweet_id"), F.col(text_col).alias("texto"))
    return rows.crossJoin(F.broadcast(criteria.select("slug", "criterio"))).withColumn("nivel_humano", F.lit(""))
