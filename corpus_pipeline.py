"""The corpus pipeline: quality rules, exact dedup, near-dedup, mixing and byte-level BPE.

Each stage takes the documents that the one before kept, as a DataFrame read from Parquet; all but the last return the
columns of documents. The last returns doc_id, lang, source, n_tokens, ids and round_trip (whether the decoded ids
give the text again). What a stage writes to the shared folder for itself goes in run() when its result is written. Of stages that are
called one by one it goes when the next one over the same sf_dir is given documents that are read from other files.

Defined cases: documents of null, empty or short text go in the first stage; a document of any length is judged, compared and encoded
whole; of equal texts the largest doc_id stays, rows without an id after all others; of near duplicates the smallest; rows
without an id and with texts of their own stay; rows that share an id are judged each by its own text; further columns, whatever
their names, pass through all stages but the last; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tesela.llm import bpe, exact_dedup, mixing, near_dedup, quality_rules
from tesela.llm.common import clear_scratch, drop, kept_at, scratch_mark, scratch_since, table
from tesela.llm.queries import split_pattern, tokenizer


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoded_and_checked(docs, tokenizer("byte_bpe_50k.tiktoken"), split_pattern(), ["doc_id", "lang", "source"])


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Scratch paths that the stages called so far have left, by sf_dir.
_left: dict[str, list[str]] = {}


def _after_others(stage: Stage, first: bool) -> Stage:
    """The stage, which deletes what those before it left, texts among it, once their results are written: that is, if all that
    docs reads is files, and none of what they left."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        left = [] if first else _left.get(sf_dir, [])
        files = docs.inputFiles() if left else []
        names = [path.split("/")[-2] for path in left]  # these hold a UUID
        if files and not any(f"/{name}/" in file for file in files for name in names):
            for path in left:
                drop(spark, path)
            left = []
        mark = scratch_mark()
        found = stage(spark, docs, sf_dir)
        _left[sf_dir] = left + scratch_since(mark)
        return found

    return run_stage


STAGES = [
    ("quality rules", _after_others(rules, True)),
    ("exact dedup", _after_others(exact, False)),
    ("near-dedup", _after_others(near, False)),
    ("mixing to target weights", _after_others(mixture, False)),
    ("byte-level BPE", _after_others(tokens, False)),
]

#: Near-duplicates, posteriors and token ids are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each result written as Parquet and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        mark = scratch_mark()
        docs, path = kept_at(stage(spark, docs, sf_dir), f"pipeline-{k}")
        clear_scratch(spark, mark, {path})
        if before:
            drop(spark, before)
        before = path
    return docs
