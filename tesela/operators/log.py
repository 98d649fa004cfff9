"""The append-only score log: resolution, resumption, audit.

A log has the columns of schema.RECORD and seq, the order of writing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import LEVEL_STATES, RESULT_STATES, kept_states

PAIR = ["tweet_id", "slug"]


def is_result() -> Column:
    return F.coalesce(F.col("estado").isin(*RESULT_STATES), F.lit(False))


def resolve(log: DataFrame) -> DataFrame:
    """One record per pair: the last in a result state, else the last. One aggregation with a partial step before its
    only shuffle."""
    rest = [c for c in log.columns if c not in PAIR]
    best = log.groupBy(*PAIR).agg(F.max_by(F.struct(*rest), F.struct(is_result(), F.col("seq"))).alias("r"))
    return best.select(*PAIR, *[F.col(f"r.{c}").alias(c) for c in rest])


def done(log: DataFrame, scope: str = "fallidos") -> DataFrame:
    """Pairs that a resumption in this scope keeps: any of their records is in a kept state. The resolved record is
    in one exactly then, so only pairs and states are aggregated."""
    states = kept_states(scope)
    hits = log.where(F.col("estado").isin(*states)) if states else log.where(F.lit(False))
    return hits.select(*PAIR).distinct()


def pending(selection: DataFrame, slugs: Sequence[str], log: DataFrame, scope: str = "fallidos", id_col: str = "id") -> DataFrame:
    """tweet_id, slug still to be scored: the selection's ids times the criteria, minus the pairs that are done."""
    each = F.explode(F.array(*[F.lit(s) for s in slugs])).alias("slug")
    return selection.select(F.col(id_col).cast("string").alias("tweet_id"), each).join(done(log, scope), PAIR, "left_anti")


def rescore_estimate(selection: DataFrame, slugs: Sequence[str], log: DataFrame, scopes: Sequence[str] = ("fallidos", "sin-nivel", "todo"), id_col: str = "id") -> DataFrame:
    """scope, total, recovered, to_score, from one pass over the log."""
    ids = selection.select(F.col(id_col).cast("string").alias("tweet_id"))
    pairs = ids.select("tweet_id", F.explode(F.array(*[F.lit(s) for s in slugs])).alias("slug"))
    best = log.groupBy(*PAIR).agg(F.max(F.when(F.col("estado").isin(*LEVEL_STATES), 2).when(F.col("estado").isin(*RESULT_STATES), 1).otherwise(0)).alias("best"))
    need = {"fallidos": 1, "sin-nivel": 2, "todo": 3}
    one = pairs.join(best, PAIR, "left").agg(F.count("*").alias("total"), *[F.count_if(F.coalesce("best", F.lit(0)) >= need[s]).alias(s) for s in scopes])
    rows = F.explode(F.array(*[F.struct(F.lit(s).alias("scope"), F.col(s).alias("recovered")) for s in scopes])).alias("r")
    return one.select("total", rows).select("r.scope", "total", "r.recovered", (F.col("total") - F.col("r.recovered")).alias("to_score"))


def audit(log: DataFrame, unreadable: int = 0) -> DataFrame:
    """One row: records, unreadable, pairs, tweets, criteria, repeated pairs, most repetitions, resolved, failed."""
    pairs = log.groupBy(*PAIR).agg(F.count("*").alias("n"), F.max(is_result()).alias("ok"))
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("records"), F.lit(unreadable).cast("long").alias("unreadable"), F.count("*").alias("pairs"),
        F.countDistinct("tweet_id").alias("tweets"), F.countDistinct("slug").alias("criteria"), F.count_if(F.col("n") > 1).alias("repeated"),
        F.coalesce(F.max("n"), F.lit(0)).cast("long").alias("most"), F.count_if("ok").alias("resolved"), F.count_if(~F.col("ok")).alias("failed"),
    )


def state_histogram(log: DataFrame) -> DataFrame:
    """estado, n, share of the resolved log, most frequent first."""
    counts = resolve(log.select(*PAIR, "estado", "seq")).groupBy("estado").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select("estado", "n", F.round(F.col("n") / total, 6).alias("share")).orderBy(F.desc("n"), "estado")


def top_failures(log: DataFrame, k: int = 5, prefix: int = 110) -> DataFrame:
    """The k most frequent diagnostics of records in no result state, by their first characters."""
    bad = log.where(~is_result() & (F.coalesce("detalle", F.lit("")) != ""))
    return bad.groupBy("estado", F.substring("detalle", 1, prefix).alias("diagnostico")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "estado", "diagnostico").limit(k)


def failure_streaks(log: DataFrame, least: int = 2, by: str | None = None) -> DataFrame:
    """Maximal runs of `least` or more records in no result state: first, last and length, in the order of seq inside
    each value of `by`, or over the whole log."""
    return _streaks(log.select(*([by] if by else []), "seq", is_result().alias("good")), least, [by] if by else [])


def row_streaks(log: DataFrame, least: int = 2) -> DataFrame:
    """Runs of `least` or more rows (tweets) whose records all failed, in the order of their last records. Any result of a row
    ends a run; this is what the circuit breaker counts."""
    rows = log.groupBy("tweet_id").agg(F.max("seq").alias("seq"), F.max(is_result()).alias("good"))
    return _streaks(rows.select("seq", "good"), least, [])


def _streaks(rows: DataFrame, least: int, by: list[str]) -> DataFrame:
    """Runs of rows (by, seq, good) that are not good. They are found inside ranges of seq and joined at their
    ends, so no task gets all rows of a sequence; about 65,536 ranges of a sequence at most, two ends each, are ordered as a whole."""
    low, high = rows.agg(F.min("seq"), F.max("seq")).first()
    size = max(1 << 16, ((high or 0) - (low or 0)) >> 16)
    w = Window.partitionBy(*by, "chunk").orderBy("seq")
    islands = rows.withColumn("chunk", F.floor(F.col("seq") / F.lit(size))).withColumn("island", F.sum(F.col("good").cast("long")).over(w))
    bad = F.when(~F.col("good"), F.col("seq"))
    parts = islands.groupBy(*by, "chunk", "island").agg(F.min(bad).alias("f"), F.max(bad).alias("l"), F.count_if(~F.col("good")).alias("n"), F.max("good").alias("has_good"))
    ends = Window.partitionBy(*by, "chunk")
    parts = parts.withColumn("edge", (F.col("island") == F.min("island").over(ends)) | (F.col("island") == F.max("island").over(ends)))
    inner = parts.where("NOT edge AND n > 0").select(*by, F.col("f").alias("first_seq"), F.col("l").alias("last_seq"), F.col("n").alias("length"))
    # A part opens with a good record unless it is its chunk's first; so a part without one goes on from the part before.
    order = Window.partitionBy(*by).orderBy("chunk", "island")
    joined = parts.where("edge").withColumn("run", F.sum(F.col("has_good").cast("long")).over(order)).where("n > 0")
    outer = joined.groupBy(*by, "run").agg(F.min("f").alias("first_seq"), F.max("l").alias("last_seq"), F.sum("n").alias("length")).drop("run")
    return inner.unionByName(outer).where(F.col("length") >= least)


def breaker_tripped(records: Sequence[dict], streak: int, limit: int = 20) -> tuple[bool, int]:
    """The circuit breaker over one micro-batch in order of seq: rows whose records all failed lengthen the streak, any
    result resets it."""
    rows: dict[str, bool] = {}
    for r in records:
        rows[r["tweet_id"]] = rows.get(r["tweet_id"], False) or r["estado"] in RESULT_STATES
    for good in rows.values():
        streak = 0 if good else streak + 1
        if streak >= limit:
            return True, streak
    return False, streak


def slug_difference(log: DataFrame, rubric_slugs: Sequence[str]) -> DataFrame:
    """slug, side: in the log but not the rubric, or the other way round."""
    seen = log.select("slug").distinct()
    known = log.sparkSession.createDataFrame([(s,) for s in rubric_slugs], "slug string")
    return seen.exceptAll(known.distinct()).withColumn("side", F.lit("log")).unionByName(known.exceptAll(seen).withColumn("side", F.lit("rubric")))


def check_correspondence(log: DataFrame, rubric_slugs: Sequence[str], fingerprint: str | None = None, recorded: str | None = None, force: bool = False) -> list[str]:
    """The reasons why a log does not belong to a rubric; raises unless forced. Slugs are few, so they are collected."""
    reasons = [f"the log has criterion {r['slug']!r}, which the rubric lacks" for r in slug_difference(log, rubric_slugs).where("side = 'log'").orderBy("slug").collect()]
    if recorded and fingerprint and recorded != fingerprint:
        reasons.append(f"the log was scored with rubric {recorded}, this one is {fingerprint}")
    if reasons and not force:
        raise ValueError("; ".join(reasons))
    return reasons
