"""Append-only logs as folders of JSON lines, and imported files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RECORD

BAD = "_bad"


def read_log(spark: SparkSession, path: str, schema: T.StructType = RECORD, key: tuple[str, ...] = ("tweet_id", "slug")) -> DataFrame:
    """The readable records of a log, with seq. Lines that are no JSON or lack a key are left out."""
    return parsed(spark, path, schema, key).where(F.col("readable")).drop("readable", BAD)


def judged_lines(lines: DataFrame, schema: T.StructType = RECORD, key: tuple[str, ...] = ("tweet_id", "slug")) -> DataFrame:
    """The lines (value) that are not blank, with r, what they hold, and readable: whether they are JSON and have the key."""
    full = T.StructType([*schema.fields, T.StructField("seq", T.LongType()), T.StructField(BAD, T.StringType())])
    rows = lines.where(F.trim("value") != "").withColumn("r", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}))
    keyed = F.col(f"r.{BAD}").isNull()
    for k in key:
        keyed = keyed & F.col(f"r.{k}").isNotNull()
    return rows.withColumn("readable", F.coalesce(keyed, F.lit(False)))


def parsed(spark: SparkSession, path: str, schema: T.StructType = RECORD, key: tuple[str, ...] = ("tweet_id", "slug")) -> DataFrame:
    """Every non-blank line: the schema's columns, seq, readable. seq is the records' own where every readable one has it. Else the
    lines are numbered in the order of file names and, inside a file, of its splits and lines, however Spark packs the splits into tasks;
    one row for each split comes to the driver for that."""
    file, begins = F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__begins")
    text = spark.read.text(path).select("value", file, begins, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("__line"))
    rows = judged_lines(text, schema, key)
    splits = rows.groupBy("__file", "__begins").agg(F.count_if(F.col("readable") & F.col("r.seq").isNull()).alias("bare")).collect()
    out = [*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields], "readable", F.col(f"r.{BAD}").alias(BAD)]
    if not any(r["bare"] for r in splits):
        return rows.select(*out, F.col("r.seq").alias("seq"))
    places = [(f, at, k) for k, (f, at) in enumerate(sorted((r["__file"], r["__begins"]) for r in splits))]
    placed = rows.join(F.broadcast(spark.createDataFrame(places, "__file string, __begins long, __place long")), ["__file", "__begins"])
    return placed.select(*out, (F.shiftleft("__place", 33) + F.col("__line")).alias("seq"))


def unreadable(spark: SparkSession, path: str) -> int:
    return parsed(spark, path).where(~F.col("readable")).count()


def import_log(spark: SparkSession, path: str, out: str) -> None:
    """Files of an earlier tool as a log whose records have seq by their lines' order."""
    read_log(spark, path).write.mode("append").json(out)


def append_log(records: DataFrame, path: str, block: int) -> None:
    """Commits a block of records at once. seq orders blocks, then partitions and rows in them, without gathering them in one task; a
    block has up to 2**20 partitions of 2**20 rows."""
    at = F.monotonically_increasing_id()
    seq = F.lit(block << 40).cast("long") + F.shiftleft(F.shiftright(at, 33), 20) + at.bitwiseAND((1 << 20) - 1)
    records.withColumn("seq", seq).write.mode("append").json(path)


def next_block(log: DataFrame) -> int:
    """The number of the first block after those of a log."""
    last = log.agg(F.max("seq")).first()[0]
    return 0 if last is None else (last >> 40) + 1


def appended(spark: SparkSession, path: str, block: int, schema: T.StructType = RECORD, key: tuple[str, ...] = ("tweet_id", "slug")) -> DataFrame:
    """The records of one block."""
    return read_log(spark, path, schema, key).where((F.col("seq") >= block << 40) & (F.col("seq") < (block + 1) << 40))


def log_ids(spark: SparkSession, path: str) -> DataFrame:
    """The distinct tweet_ids of another log."""
    return read_log(spark, path).select("tweet_id").distinct()
