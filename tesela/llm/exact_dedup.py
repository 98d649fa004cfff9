"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Each level counts its keys in a distributed aggregation and keeps one bit for every key that may
occur twice. The bits (2**16 to 2**26 of them, by the number of rows) decide inside the next scan which rows go
on, so texts are never shuffled: after the last level only ids and digests of rows that may have a
copy move. Only DataFrame functions are used.

Defined cases: a null text counts as empty, so all null and empty texts form one group. Of repeated
rows with the same id and text exactly one is kept. A null id ranks below every other id. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap, bits_for, lower_ascii, marked, slot, stored, suspects


def _repeated(keys: DataFrame, bits: int):
    """The bitmap of the slots that hold two rows or more."""
    return bitmap(keys.groupBy("slot").count().where("count > 1").select("slot"), bits)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64, bitmap_bits: int | None = None, digest: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, keep_id (largest id of the equal texts), group_size, kept,
    text_sha256. Texts are equal when identical after lower-casing A-Z. text_sha256 is null for texts
    that the lengths or prefixes show to be unique, unless digest is set.

    bitmap_bits: size of a level's bitmap, by the number of rows if it is not given; on a corpus with far more texts it
    passes more rows on to the full hash and the result stays the same.
    """
    bitmap_bits = bitmap_bits or bits_for(docs.count())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    length = F.octet_length("text")
    prefix = F.xxhash64(lower_ascii(F.substring("text", 1, prefix_chars)))
    by_length, by_prefix = slot([length], bitmap_bits), slot([length, prefix], bitmap_bits)
    lengths = _repeated(rows.select(by_length.alias("slot")), bitmap_bits)
    survivors = rows.where(marked(lengths, by_length))
    prefixes = _repeated(survivors.select(by_prefix.alias("slot")), bitmap_bits)
    twin = F.when(marked(lengths, by_length), marked(prefixes, by_prefix)).otherwise(False)
    full = F.sha2(lower_ascii(F.col("text")), 256)
    hashed = rows.select("doc_id", twin.alias("twin"), "text").select("doc_id", "twin", (full if digest else F.when(F.col("twin"), full)).alias("text_sha256"), F.monotonically_increasing_id().alias("rid"))
    hashed = stored(hashed, "op9-hashes")

    twins = hashed.where("twin")
    groups = twins.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "rid")).alias("last"), F.count("*").alias("group_size"))
    found = twins.join(groups, "text_sha256").select("doc_id", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("last.rid")).alias("kept"), "text_sha256")
    alone = hashed.where(~F.col("twin")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    return alone.unionByName(found)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the copies, with its own columns. Rows leave by id and digest; of repeated rows
    with one id and text, which those cannot tell apart, a single one stays."""
    found = stored(exact_dedup(docs, id_col, text_col).where("group_size > 1"), "op9-found")
    pair = [F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")]
    gone, stay = found.where("NOT kept").select(*pair), found.where("kept").select(*pair)
    same = lambda x, y: x["__id"].eqNullSafe(y["__id"]) & (x["__sha"] == y["__sha"])
    outright = gone.join(stay, same(gone, stay), "left_anti")
    full = F.sha2(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), 256)
    some, others = suspects(docs, id_col, gone.select("__id"))
    some = some.withColumn("__full", full)
    left = others.unionByName(some.join(outright, some[id_col].eqNullSafe(outright["__id"]) & (some["__full"] == outright["__sha"]), "left_anti").drop("__full"))
    again = gone.join(stay, same(gone, stay), "left_semi").distinct()
    if again.isEmpty():
        return left
    keyed = left.withColumn("__full", full)
    at = keyed[id_col].eqNullSafe(again["__id"]) & (keyed["__full"] == again["__sha"])
    once = keyed.join(again, at, "left_semi").dropDuplicates([id_col, "__full"])
    return keyed.join(again, at, "left_anti").unionByName(once).drop("__full")
