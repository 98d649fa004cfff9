"""What several operators of this subpackage share: the shared scratch folder, tables kept in it,
fixed-size key bitmaps, text expressions and the slicing of Arrow batches by bytes."""

from __future__ import annotations

import contextlib
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Functions of this subpackage travel to the executors by value, so those need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules["tesela.llm"])

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share. Unset, a local
    master gets a temporary folder; a cluster is refused, as its machines share none."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tesela-")
        sc.setCheckpointDir(found)
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


#: Scratch paths of this driver, in the order in which they were made.
_made: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it is deleted when the application ends, if not before."""
    path = f"{shared_dir(spark)}/tesela/{name}-{uuid.uuid4().hex}"
    fs, jpath = _fs(spark, path)
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    _made.append(path + "/data")
    return path + "/data"


def scratch_mark() -> int:
    """A place in the order of scratch paths, for clear_scratch()."""
    return len(_made)


def clear_scratch(spark: SparkSession, mark: int, keep: set[str]) -> None:
    """Deletes the scratch tables made since mark but those at the paths keep, which later steps read."""
    for path in _made[mark:]:
        if path not in keep:
            drop(spark, path)
    _made[mark:] = [p for p in _made[mark:] if p in keep]


def scratch_since(mark: int) -> list[str]:
    """The paths of the scratch tables made since mark that clear_scratch() has not deleted."""
    return _made[mark:]


def drop(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path.removesuffix("/data"))
    fs.delete(jpath, True)


def kept_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df written as Parquet to the shared folder and read again, which cuts its lineage and outlives
    any executor; and its path."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    return kept_at(df, name)[0]


def few(df: DataFrame, rows: int, each: int = 100_000) -> DataFrame:
    """df of about so many rows in a task for each `each` of them, or as many as it has. A small table behind a shuffle takes
    a task, and a file, for each of its partitions otherwise."""
    return df.coalesce(rows // each + 1)


def lower_ascii(text: Column) -> Column:
    """text with only A-Z lower-cased; a text of ASCII alone takes the fast built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; an empty array without any."""
    bare = F.trim(text, F.lit(SPACES))
    return F.when(F.coalesce(F.length(bare) == 0, F.lit(True)), F.array().cast("array<string>")).otherwise(F.split(bare, r"[ \t-\r]+", -1))


# ------------------------------------------------------------------------------- bitmaps of keys


def slot(keys: list[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits).cast("long"))


def bitmap(slots: DataFrame, bits: int, keys: int | None = None) -> Column:
    """A scalar subquery: one bit for each value of the column slot, as bits / 64 longs. Its size does
    not depend on the data; a crowded bitmap lets more rows through and never fewer. With the number of keys, tasks follow it."""
    spark = slots.sparkSession
    lit64 = F.lit(64).cast("long")
    full = spark.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b"))
    some = slots.select(F.floor(F.col("slot") / lit64).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("slot", lit64).cast("int")).alias("b"))
    packed = some.unionByName(full).groupBy("w").agg(F.bit_or("b").alias("b"))
    packed = packed if keys is None else few(packed, max(keys, bits // 64))
    one = packed.agg(F.sort_array(F.collect_list(F.struct("w", "b"))).alias("a")).select(F.transform("a", lambda x: x["b"]).alias("a"))
    return one.scalar()


def marked(bits_of: Column, at: Column) -> Column:
    word = F.get(bits_of, F.floor(at / 64).cast("int"))
    return F.call_function("shiftright", word, F.pmod(at, F.lit(64).cast("long")).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def bits_for(keys: int) -> int:
    """The size of a bitmap in which so many keys mark about a sixteenth of the slots: 2**16 to 2**26 bits (8 MB). Beyond some
    four million keys it is more crowded, lets more rows through to the join, and results stay the same."""
    return 1 << min(26, max(16, (16 * keys).bit_length()))


def suspects(df: DataFrame, id_col: str, ids: DataFrame, bits: int | None = None, thin: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows of df whose id may be among ids (its single column, a table that is cheap to count), and the others. Only the
    first need a join, so only they are shuffled for one. thin: the bitmap takes as many tasks as the ids need."""
    keys = ids.count() if thin or not bits else None
    bits = bits or bits_for(keys)
    maybe = marked(bitmap(ids.select(slot([F.col(ids.columns[0])], bits).alias("slot")), bits, keys if thin else None), slot([F.col(id_col)], bits))
    return df.where(maybe), df.where(~maybe)


# -------------------------------------------------------------------- bounded samples of labelled rows


def drawn(known: DataFrame, by: str, sample: int, seed: int) -> tuple[DataFrame, dict]:
    """doc_id and by of at most `sample` distinct documents for each value of `by`, those with the least hashes of their ids, and the
    rows that known (doc_id, by) has of each value. However often rows repeat, documents are drawn as long as there are
    any, and what is counted, ranked or collected stays a small multiple of the sample."""
    sizes = {r[by]: r["n"] for r in known.groupBy(by).agg(F.count("*").alias("n")).collect()}
    scale = 1 << 40
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(scale).cast("long"))
    share = {k: min(scale, 2 * sample * scale // n + 1) for k, n in sizes.items()}
    while sizes:
        below = F.create_map(*[F.lit(x) for k in sorted(share) for x in (k, share[k])])
        found = stored(known.select("doc_id", by, draw.alias("__h")).where(F.col("__h") < F.element_at(below, F.col(by))).distinct(), "drawn")
        got = {r[by]: r["n"] for r in found.groupBy(by).agg(F.count("*").alias("n")).collect()}
        short = [k for k in sizes if got.get(k, 0) < sample and share[k] < scale]
        if not short:
            rank = F.row_number().over(Window.partitionBy(by).orderBy("__h", "doc_id"))
            return found.withColumn("__r", rank).where(F.col("__r") <= sample).select("doc_id", by), sizes
        share |= {k: min(scale, 16 * share[k]) for k in short}
    return known.select("doc_id", by).limit(0), sizes


# ------------------------------------------------------------------------------- Arrow batches


def process_cache() -> dict:
    """A dict that lives as long as the Python worker, over all its tasks."""
    return sys.modules.setdefault("_tesela_cache", types.ModuleType("_tesela_cache")).__dict__


def sliced(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice's column holds about `most` bytes; a longer text is alone."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at, total = 0, 0
        for i, n in enumerate(sizes):
            if total and total + n > most:
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += int(n)
        if batch.num_rows > at:
            yield batch.slice(at)
    give_back()


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows at most while an eager step with wide rows runs."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def give_back() -> None:
    """Returns freed memory of the Python worker to the system, as idle workers live on beside the next stage."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def texts_of(column: pa.Array) -> list[str]:
    """Python strings; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def bytes_of(column: pa.Array) -> tuple:
    """The UTF-8 bytes of a string column in one numpy array, and the offsets of its rows; null counts
    as empty."""
    import numpy as np

    column = pa.compute.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]
