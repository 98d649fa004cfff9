"""Key resolution and consolidation of two corpora."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

SEPARATOR = "\x1f"


def is_real(x: Column) -> Column:
    return F.coalesce(strip(x.cast("string")).rlike(r"^[0-9]{19}\z"), F.lit(False))


def synthetic(user: Column, created: Column, text: Column) -> Column:
    """A key from content: local: and 16 hex digits."""
    parts = [F.coalesce(c, F.lit("")) for c in (user, created, text)]
    return F.concat(F.lit("local:"), F.substring(F.sha2(F.concat_ws(SEPARATOR, *parts), 256), 1, 16))


def synthetic_blake2s(df: DataFrame, user: str, created: str, text: str, out: str = "id") -> DataFrame:
    """synthetic() with BLAKE2s, which Spark lacks, for keys made by earlier tools."""
    @F.pandas_udf("string")
    def key(u: pd.Series, c: pd.Series, t: pd.Series) -> pd.Series:
        rows = zip(u.fillna(""), c.fillna(""), t.fillna(""), strict=True)
        return pd.Series(["local:" + hashlib.blake2s("\x1f".join(r).encode(), digest_size=8).hexdigest() for r in rows])

    return df.withColumn(out, key(user, created, text))


def resolved(df: DataFrame, id_col: str = "id", raw_col: str = "raw_json", user: str = "author_username", created: str = "created_at", text: str = "text") -> DataFrame:
    """df with id_col resolved and key_source: flat, json or synthetic."""
    raw = strip(F.coalesce(F.col(raw_col), F.lit("")))
    inner = F.when(raw.startswith("{"), F.get_json_object(raw, "$.id"))
    flat, inside = strip(F.col(id_col).cast("string")), strip(inner)
    made = synthetic(F.col(user), F.col(created), F.col(text))
    both = F.when(is_real(flat), F.struct(flat.alias("k"), F.lit("flat").alias("s"))).when(is_real(inside), F.struct(inside.alias("k"), F.lit("json").alias("s"))).otherwise(F.struct(made.alias("k"), F.lit("synthetic").alias("s")))
    return df.withColumn("__key", both).withColumn(id_col, F.col("__key.k")).withColumn("key_source", F.col("__key.s")).drop("__key")


def collisions(df: DataFrame, id_col: str = "id") -> DataFrame:
    return df.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1")


def consolidated(base: DataFrame, extra: DataFrame, id_col: str = "id") -> DataFrame:
    """base, and the rows of extra with other keys, in base's columns; a null in them is ""."""
    new = extra.join(base.select(id_col), id_col, "left_anti")
    return base.unionByName(new, allowMissingColumns=True).select(base.columns).na.fill("")


def consolidate(base: DataFrame, extra: DataFrame, id_col: str = "id") -> DataFrame:
    """consolidated(), or an error before anything is written if a key repeats or is neither real nor synthetic."""
    out = consolidated(base, extra, id_col)
    state = integrity(out, id_col).first()
    if state["repeated"] or state["malformed"]:
        raise ValueError(f"{state['repeated']} repeated and {state['malformed']} malformed keys")
    return out


def integrity(df: DataFrame, id_col: str = "id") -> DataFrame:
    """rows, distinct keys, repeated keys, synthetic and malformed rows in one aggregation."""
    made = F.col(id_col).rlike(r"^local:[0-9a-f]{16}\z")
    g = df.groupBy(id_col).agg(F.count("*").alias("n"))
    return g.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"), F.count("*").alias("keys"), F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(made).alias("synthetic"), F.count_if(~made & ~is_real(F.col(id_col))).alias("malformed"))


def column_differences(base: DataFrame, extra: DataFrame) -> tuple[list[str], list[str]]:
    """Columns that only base has, and only extra."""
    return sorted(set(base.columns) - set(extra.columns)), sorted(set(extra.columns) - set(base.columns))
