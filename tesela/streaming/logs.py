"""The score log as a stream: records arrive as files, the resolved table follows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.log import PAIR, resolve
from ..schema import RECORD

LOGGED = T.StructType([*RECORD.fields, T.StructField("seq", T.LongType())])


def read_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LOGGED)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).json(path)


def follow(stream: DataFrame, out: str, checkpoint: str, buckets: int = 16) -> StreamingQuery:
    """Keeps the resolved log below out, in buckets by a hash of the pair. A batch reads and writes the buckets that it has records of,
    by the rule of resolve(), which may be applied in parts; a bucket's version before its last stays until the next, and older ones go.
    No watermark, as a late result still wins. A repeated batch writes the same version again. Read it with current()."""

    def merge(batch: DataFrame, k: int) -> None:
        spark = batch.sparkSession
        new = batch.select(*LOGGED.names, F.pmod(F.xxhash64(*PAIR), F.lit(buckets)).cast("int").alias("bucket"))
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]
        old = _versions(spark, out, k)
        paths = [f"{out}/v{old[b][-1]}/bucket={b}" for b in touched if b in old]
        both = new.unionByName(spark.read.schema(LOGGED).parquet(*paths).withColumn("bucket", F.pmod(F.xxhash64(*PAIR), F.lit(buckets)).cast("int"))) if paths else new
        resolve(both).write.mode("overwrite").partitionBy("bucket").parquet(f"{out}/v{k}")
        fs, at = _fs(spark, out)
        for b in touched:
            for v in old.get(b, [])[:-1]:
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{out}/v{v}/bucket={b}"), True)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _versions(spark: SparkSession, out: str, before: int | None = None) -> dict[int, list[int]]:
    """The committed versions of each bucket in order, those below `before` if it is given."""
    fs, at = _fs(spark, out)
    found: dict[int, list[int]] = {}
    for v in fs.listStatus(at) if fs.exists(at) else []:
        name = v.getPath().getName()
        k = int(name[1:]) if name[:1] == "v" and name[1:].isdigit() else None
        if k is None or (before is not None and k >= before) or not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(v.getPath(), "_SUCCESS")):
            continue
        for b in fs.listStatus(v.getPath()):
            key, eq, value = b.getPath().getName().partition("=")
            if eq and key == "bucket":
                found.setdefault(int(value), []).append(k)
    return {b: sorted(ks) for b, ks in found.items()}


def current(spark: SparkSession, out: str) -> DataFrame:
    """The resolved log that follow() keeps."""
    paths = [f"{out}/v{ks[-1]}/bucket={b}" for b, ks in _versions(spark, out).items()]
    return spark.read.schema(LOGGED).parquet(*paths) if paths else spark.createDataFrame([], LOGGED)


def states(stream: DataFrame) -> DataFrame:
    """Running counts by criterion and state of all records."""
    return stream.groupBy("slug", "estado").agg(F.count("*").alias("n"))


def windowed(stream: DataFrame, ts_col: str, window: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Records by event-time window and state; records later than delay are left out."""
    return stream.withWatermark(ts_col, delay).groupBy(F.window(ts_col, window), "estado").agg(F.count("*").alias("n"))


__all__ = ["LOGGED", "PAIR", "current", "follow", "read_stream", "states", "windowed"]
