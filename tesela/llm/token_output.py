"""Token ids as Parquet list columns.

Documents are range-partitioned by doc_id while they are still text, encoded partition by partition
with the tokenizers library and written in ascending order, one file a partition: columns doc_id,
n_tokens and ids (list of int). The writer's dictionary or delta encoding, row-group size and page size are
parameters; Parquet's page indexes let a reader skip to the pages of the doc_ids it asks for, and the columns apart
let it read lengths without tokens. Spark commits the files, so a lost executor leaves no partial output, and reads them
back by row groups.

Defined cases: a null text is empty and has the end id alone; rows that share a doc_id stand in the order in which the input's
files have them and may be dealt over several files; null ids come first; a text of any length is one row; the string of a special
token in a text is that token, as the library has it; an empty table writes no rows; other columns are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import Codec, lists, read_file, rows_of
from .common import bytes_of, give_back, kept_at, scratch, sliced, small_batches

END_ID = 0
#: Stored bytes of texts that a token file is made from at most.
FILE_BYTES = 128 << 20


def _ranges(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) in ascending order over files: range-partitioned by doc_id and, for rows that share one, by their place in
    the input, into the session's number of shuffle partitions, or into more where the planner's estimate of docs asks for
    files of FILE_BYTES."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts, usual = -(-size // FILE_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, order = docs.withColumn("place", F.monotonically_increasing_id()), ("doc_id", "place")
    # an estimate beyond any real table means that the planner has none
    dealt = rows.repartitionByRange(parts, *order) if usual < parts <= 1 << 20 else rows.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).drop("place")


def write_tokens(docs: DataFrame, out: str, tokenizer_path: str, end_id: int = END_ID, encoding: str = "dictionary", row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10, page_rows: int = 2_000) -> None:
    """Writes every document's ids and end_id below out. encoding: "dictionary" or "delta"."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"encoding must be dictionary or delta, not {encoding!r}")
    data = docs.sparkSession.sparkContext.broadcast(read_file(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(data.value, None)
        for batch in sliced(batches, "text"):
            found, at = codec.encode_bytes(*bytes_of(batch.column("text")))
            ids = lists(np.insert(found, at[1:], end_id), at + np.arange(len(at)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.compute.list_value_length(ids), ids], ["doc_id", "n_tokens", "ids"])

    tokens = _ranges(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(run, "doc_id long, n_tokens int, ids array<int>")
    options = {
        "compression": "snappy",
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
        "parquet.writer.version": "PARQUET_1_0" if encoding == "dictionary" else "PARQUET_2_0",
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows,
        "parquet.dictionary.page.size": 1 << 20,
    }
    with small_batches(docs.sparkSession, 2000):
        tokens.write.options(**options).mode("overwrite").parquet(out)


def read_tokens(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids of the documents with low <= doc_id <= high; both filters reach the page index."""
    df = spark.read.schema("doc_id long, n_tokens int, ids array<int>").parquet(path)
    df = df.where(F.col("doc_id") >= low) if low is not None else df
    return df.where(F.col("doc_id") <= high) if high is not None else df


def read_lengths(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and n_tokens; the ids are not read."""
    return spark.read.schema("doc_id long, n_tokens int").parquet(path)


def _index_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = rows_of(batch.column("ids"))
        crc = pa.array([zlib.crc32(r.astype("<u4", copy=False)) for r in ids], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("row"), batch.column("doc_id"), pa.array([len(r) for r in ids], pa.int64()), crc], ["file", "row", "doc_id", "n_tokens", "ids_crc32"])
    give_back()


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files: start counts the ids of all documents before. The files are read by row
    groups; one total of each file is ordered over all files, and lengths inside a file."""
    files = spark.read.schema("doc_id long, n_tokens int, ids array<int>").parquet(path)
    file, row = F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    with small_batches(spark, 1000):
        rows, _ = kept_at(files.select(file, row, "doc_id", "ids").mapInArrow(_index_of, "file string, row long, doc_id long, n_tokens long, ids_crc32 long"), "op5-index")
    lengths = files.groupBy(F.col("_metadata.file_name").alias("name")).agg(F.sum("n_tokens").alias("total"))
    part = F.regexp_extract("name", r"^part-(\d+)", 1).cast("long")
    before = lengths.select("name", (F.sum("total").over(Window.orderBy(part, "name").rowsBetween(Window.unboundedPreceding, 0)) - F.col("total")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    placed = rows.withColumn("inside", inside).join(before, F.col("file") == F.col("name"))
    return placed.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Writes the token files to the shared folder and gives their index."""
    out = scratch(docs.sparkSession, "op5-tokens")
    write_tokens(docs, out, tokenizer_path)
    return token_index(docs.sparkSession, out)
