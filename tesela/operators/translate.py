"""Translation: targets, merge-back, token preservation and language contrast."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import StructuralFailure
from ..functions.text import LANGUAGE_NAMES, NO_LANGUAGE, failure_of, strip, tokens
from .scoring import backoff, limited


def last_of_each(log: DataFrame) -> DataFrame:
    """The last record of each tweet_id by seq."""
    rest = [c for c in log.columns if c != "tweet_id"]
    return log.groupBy("tweet_id").agg(F.max_by(F.struct(*rest), F.col("seq")).alias("r")).select("tweet_id", *[F.col(f"r.{c}").alias(c) for c in rest])


def _blank(c: str) -> Column:
    return strip(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""


def targets(corpus: DataFrame, log: DataFrame, again: bool = False, id_col: str = "id", text_col: str = "text_completo", translation_col: str = "traducción") -> DataFrame:
    """Rows with text and no translation (or all, again) that the log has no finished translation of; retry tells those that
    were tried before."""
    want = corpus.where(~_blank(text_col))
    want = want if again or translation_col not in corpus.columns else want.where(_blank(translation_col))
    last = last_of_each(log).select("tweet_id", F.col("estado").alias("__estado"))
    joined = want.withColumn("__id", F.col(id_col).cast("string")).join(last, F.col("__id") == last["tweet_id"], "left")
    open_ = joined.where(F.coalesce(F.col("__estado") != "OK", F.lit(True)))
    return open_.select(*corpus.columns, F.col("__estado").isNotNull().alias("retry"))


def _joined(corpus: DataFrame, log: DataFrame, again: bool, id_col: str, text_col: str, translation_col: str) -> DataFrame:
    """corpus with __target (whether the row was to be translated), __ok (a finished translation) and __es, __t of it."""
    last = last_of_each(log).select("tweet_id", F.col("estado").alias("__estado"), F.col("ya_esta_en_espanol").alias("__es"), F.col("traduccion").alias("__t"))
    base = corpus if translation_col in corpus.columns else corpus.withColumn(translation_col, F.lit(""))
    joined = base.join(last, F.col(id_col).cast("string") == last["tweet_id"], "left")
    target = ~_blank(text_col) & (F.lit(True) if again else _blank(translation_col))
    return joined.withColumns({"__target": target, "__ok": F.coalesce(F.col("__estado") == "OK", F.lit(False)), "__es": F.coalesce("__es", F.lit(False))})


def merged(corpus: DataFrame, log: DataFrame, id_col: str = "id", text_col: str = "text_completo", translation_col: str = "traducción", again: bool = False) -> DataFrame:
    """corpus with translations filled in where there is none (or everywhere, again): Spanish text is copied as it is, a finished translation
    taken, the rest left."""
    joined = _joined(corpus, log, again, id_col, text_col, translation_col)
    fresh = F.when(F.col("__es"), F.col(text_col)).otherwise(F.coalesce("__t", F.lit("")))
    new = F.when(F.col("__target") & F.col("__ok"), fresh).otherwise(F.col(translation_col)).alias(translation_col)
    return joined.select(*[new if c == translation_col else F.col(c) for c in (corpus.columns if translation_col in corpus.columns else [*corpus.columns, translation_col])])


def fill_report(corpus: DataFrame, log: DataFrame, id_col: str = "id", text_col: str = "text_completo", translation_col: str = "traducción", again: bool = False) -> DataFrame:
    """rows; of those to be translated the ones translated, copied as Spanish and failed; and rows with a translation after merging."""
    joined = _joined(corpus, log, again, id_col, text_col, translation_col)
    hit = F.col("__target") & F.col("__ok")
    fresh = F.when(F.col("__es"), F.col(text_col)).otherwise(F.coalesce("__t", F.lit("")))
    filled = strip(F.coalesce(F.when(hit, fresh).otherwise(F.col(translation_col)), F.lit(""))) != ""
    return joined.agg(
        F.count("*").alias("rows"), F.count_if(hit & ~F.col("__es")).alias("translated"), F.count_if(hit & F.col("__es")).alias("copied"),
        F.count_if(F.col("__target") & F.col("__estado").isNotNull() & ~F.col("__ok")).alias("failed"), F.count_if(filled).alias("filled"),
    )


def lost_tokens(df: DataFrame, id_col: str = "id", text_col: str = "text_completo", translation_col: str = "traducción") -> DataFrame:
    """id, missing: links, handles and tags of the text that the translation lacks; rows with a translation that lost some."""
    some = df.where(~_blank(translation_col))
    gone = F.sort_array(F.array_distinct(F.array_except(tokens(F.col(text_col)), tokens(F.col(translation_col)))))
    return some.select(F.col(id_col).alias("id"), gone.alias("missing")).where(F.size("missing") > 0)


def _compared(corpus: DataFrame, log: DataFrame, id_col: str, lang_col: str) -> DataFrame:
    last = last_of_each(log).where("estado = 'OK'").select("tweet_id", F.lower(strip(F.coalesce("idioma_detectado", F.lit("")))).alias("detectado"))
    c = corpus.select(F.col(id_col).cast("string").alias("tweet_id"), F.lower(strip(F.coalesce(F.col(lang_col), F.lit("")))).alias("lang"))
    name = F.create_map(*[F.lit(x) for kv in LANGUAGE_NAMES.items() for x in kv])
    return c.join(last, "tweet_id").withColumns({"real": ~F.col("lang").isin(*NO_LANGUAGE), "agrees": F.coalesce(F.try_element_at(name, F.col("lang")), F.col("lang")) == F.col("detectado")})


def language_contrast(corpus: DataFrame, log: DataFrame, id_col: str = "id", lang_col: str = "lang") -> DataFrame:
    """rows with a real language, how many agree, and their share."""
    one = _compared(corpus, log, id_col, lang_col).where("real").agg(F.count("*").alias("rows"), F.count_if("agrees").alias("agree"))
    return one.withColumn("share", F.round(F.try_divide("agree", "rows"), 6))


def disagreements(corpus: DataFrame, log: DataFrame, k: int = 5, id_col: str = "id", lang_col: str = "lang") -> DataFrame:
    bad = _compared(corpus, log, id_col, lang_col).where("real AND NOT agrees")
    return bad.groupBy("lang", "detectado").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang", "detectado").limit(k)


def detected_for_codes(corpus: DataFrame, log: DataFrame, k: int = 4, id_col: str = "id", lang_col: str = "lang") -> DataFrame:
    """The k languages found most often for each code that is no language."""
    g = _compared(corpus, log, id_col, lang_col).where("NOT real").groupBy("lang", "detectado").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "detectado"))
    return g.withColumn("rank", rank).where(F.col("rank") <= k)


def cost(n: int, instruction: str, price_in: float, price_out: float) -> float:
    return n * ((len(instruction) // 4 + 110) / 1e6 * price_in + 130 / 1e6 * price_out)


def is_transient(error: BaseException) -> bool:
    return failure_of(error) in ("LIMITE_TASA", "ERROR_SERVIDOR", "TIEMPO_AGOTADO")


def translate(rows: DataFrame, translator: Callable[[str], dict], attempts: int = 3, id_col: str = "id", text_col: str = "text_completo", wait: Callable[[int], None] = backoff, timeout: float | None = None) -> DataFrame:
    """Translation records by a pluggable translator, which gives idioma_detectado, ya_esta_en_espanol and traduccion or
    raises; a credential failure ends the run, a block is final, other failures are tried again after a wait."""
    import pandas as pd

    schema = "tweet_id string, idioma_detectado string, ya_esta_en_espanol boolean, traduccion string, estado string, detalle string"

    def one(text: str) -> tuple:
        state, detail = "FALLIDA", ""
        for k in range(attempts):
            try:
                got = limited(lambda: translator(text), timeout)
                return got.get("idioma_detectado", ""), bool(got.get("ya_esta_en_espanol")), (got.get("traduccion") or "").strip(), "OK", ""
            except Exception as e:  # noqa: BLE001  it becomes a record
                kind, detail = failure_of(e), f"{type(e).__name__}: {e}"[:200]
                if kind == "PERMANENTE":
                    raise StructuralFailure(str(e)) from e
                if kind == "BLOQUEADO":
                    state = "BLOQUEADA"
                    break
                if k < attempts - 1:
                    wait(k)
        return "", False, "", state, detail

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(i, *one(t)) for i, t in zip(pdf["i"], pdf["t"], strict=True)], columns=[c.split()[0] for c in schema.split(", ")])

    return rows.select(F.col(id_col).cast("string").alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).mapInPandas(run, schema)


def translate_corpus(corpus: DataFrame, translator: Callable[[str], dict], read_log: Callable[[], DataFrame], append: Callable[[DataFrame], None], again: bool = False, calls: int = 8, **options) -> DataFrame:
    """Translates what targets() gives, `calls` rows at a time over as many tasks, appends the records to the log, and gives
    the corpus with translations. What is finished in the log is not translated again, so a run that was stopped goes on. options: id_col, text_col,
    translation_col; attempts, wait and timeout of a call."""
    cols = {k: v for k, v in options.items() if k in ("id_col", "text_col", "translation_col")}
    call = {k: v for k, v in options.items() if k in ("id_col", "text_col", "attempts", "wait", "timeout")}
    rows = targets(corpus, read_log(), again, **cols)
    append(translate(rows.repartition(max(1, calls)), translator, **call))
    return merged(corpus, read_log(), again=again, **cols)
