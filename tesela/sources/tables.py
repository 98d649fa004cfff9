"""Tables of text: CSV, TSV and spreadsheets, with every cell a string."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import CP1252, strip


def require(spark: SparkSession, path: str, what: str, made_by: str | None = None) -> str:
    """The path, or an error that names what is missing and the stage that makes it."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        raise FileNotFoundError(f"{what} is not at {path}" + (f"; the stage {made_by} makes it" if made_by else ""))
    return path


def encodings(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a path by encoding: UTF-8 if all their lines are, else the single-byte encoding that Spark reads. Lines are looked at by
    the executors; the names of files come to the driver."""
    valid = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.bool_and(F.is_valid_utf8("value")).alias("ok")).orderBy("file").collect()
    return {e: [unquote(r["file"]) for r in valid if r["ok"] == ok] for e, ok in (("UTF-8", True), ("ISO-8859-1", False))}


def read_table(spark: SparkSession, path: str, encoding: str | None = None, multi_line: bool = True) -> DataFrame:
    """A table by its suffix, all strings. Each file has the encoding that all of it is in; a cell of code page 1252 keeps its
    characters. multi_line: cells may hold line ends, so a file is one task; without, large files are split."""
    low = path.lower()
    if low.endswith((".xlsx", ".xlsm", ".xls")):
        return read_spreadsheet(spark, path)
    sep = "\t" if low.endswith(".tsv") else ","
    found = {encoding: [path]} if encoding else encodings(spark, path)
    read = lambda files, e: spark.read.csv(files, header=True, inferSchema=False, multiLine=multi_line, quote='"', escape='"', sep=sep, encoding=e)
    if not found.get("ISO-8859-1"):
        return read(path, encoding or "UTF-8")
    old = read(found["ISO-8859-1"], "ISO-8859-1")
    src, dst = "".join(chr(b) for b in CP1252.values()), "".join(CP1252)
    old = old.select(*[F.translate(F.col(f"`{c}`"), src, dst).alias(c) for c in old.columns])
    return read(found["UTF-8"], "UTF-8").unionByName(old, allowMissingColumns=True) if found.get("UTF-8") else old


def read_spreadsheet(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet of a workbook that the driver can open; it needs openpyxl."""
    try:
        import openpyxl  # noqa: F401
        import pandas as pd
    except ImportError as e:
        raise ImportError("reading spreadsheets needs openpyxl; save the sheet as CSV instead") from e
    pdf = pd.read_excel(path, dtype=str, na_values=[""], keep_default_na=False)
    return spark.createDataFrame(pdf.where(pdf.notna(), None).values.tolist(), ", ".join(f"`{c}` string" for c in pdf.columns))


def read_corpus(spark: SparkSession, path: str, required: Sequence[str] = ("id", "text_completo"), optional: Sequence[str] = ("traducción", "lang")) -> tuple[DataFrame, dict]:
    """The table, and a report: rows, repeated ids, absent optional columns; an error for an absent required one."""
    df = read_table(spark, require(spark, path, "the corpus"))
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise ValueError(f"{path} lacks the columns {', '.join(lacking)}")
    n, ids = df.selectExpr("count(*)", f"count(DISTINCT `{required[0]}`)").first()
    return df, {"rows": n, "repeated": n - ids, "absent": [c for c in optional if c not in df.columns]}


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """The source of a repair: a spreadsheet with raw_json. CSV is refused, as its ids and line ends are the damage."""
    if not path.lower().endswith((".xlsx", ".xlsm", ".xls")):
        raise ValueError("a repair starts from the spreadsheet; its CSV has lost what the repair needs")
    df = read_spreadsheet(spark, path)
    if "raw_json" not in df.columns:
        raise ValueError(f"{path} has no column raw_json")
    return df


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path).where(strip(F.coalesce("nivel_humano", F.lit(""))) != "")
