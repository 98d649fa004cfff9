"""Tidy and wide exports of a resolved log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import TIDY


def in_corpus(resolved: DataFrame, corpus: DataFrame, id_col: str = "id") -> DataFrame:
    ids = corpus.select(F.col(id_col).cast("string").alias("__id"))
    return resolved.join(ids, resolved["tweet_id"] == F.col("__id"), "left_semi")


def applies() -> Column:
    """SI, NO, or the state of a failed pair."""
    return F.when(F.col("estado") == "OK", "SI").when(F.col("estado") == "NO_APLICABLE", "NO").otherwise(F.coalesce("estado", F.lit("")))


def tidy(resolved: DataFrame, corpus: DataFrame, criteria: DataFrame, id_col: str = "id") -> DataFrame:
    """One row for each pair with the criterion's id and name; a criterion that the rubric lacks has empty ones."""
    dim = F.broadcast(criteria.select("slug", "id_criterio", "criterio"))  # the rubric's criteria
    joined = in_corpus(resolved, corpus, id_col).join(dim, "slug", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit("")) for c in ("id_criterio", "criterio")}).select(*TIDY)


def wide(resolved: DataFrame, corpus: DataFrame, slugs: Sequence[str], numeric: Sequence[str], id_col: str = "id") -> DataFrame:
    """corpus with nivel, justificacion, aplicable and (numeric scales) puntaje of every criterion. The slugs are given, so
    one aggregation by tweet makes all columns."""
    aggs = []
    for s in slugs:
        at = F.col("slug") == s
        aggs += [F.max(F.when(at, F.col("nivel"))).alias(f"{s}_nivel"), F.max(F.when(at, F.col("justificacion"))).alias(f"{s}_justificacion"), F.max(F.when(at, applies())).alias(f"{s}_aplicable")]
        if s in numeric:
            aggs.append(F.max(F.when(at, F.col("puntaje"))).alias(f"{s}_puntaje"))
    by = resolved.groupBy(F.col("tweet_id").alias("__id")).agg(*aggs)
    return corpus.join(by, F.col(id_col).cast("string") == F.col("__id"), "left").drop("__id")
