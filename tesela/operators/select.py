"""Selection of rows to score, and their payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import safe_text, strip, truthy

# The notices of a payload.
NOTICES = {
    "reply": "Este tweet es una RESPUESTA a otro tweet que NO está disponible. Califica sólo con el texto presente y di en tu justificación que el contexto previo falta.",
    "retweet": "Este tweet es un RETWEET: el texto no fue escrito por el autor de la fila.",
    "quote": "Este tweet CITA otro tweet que NO está disponible.",
}
NOTICE_HEAD = "[ADVERTENCIA DE CONTEXTO INCOMPLETO] "


def filters(df: DataFrame, langs: Sequence[str] = (), query_types: Sequence[str] = (), drop_retweets: bool = True, drop_quotes: bool = True, text_col: str = "text_completo", lang_col: str = "lang", type_col: str = "TIPO_QUERY") -> list[tuple[str, Column]]:
    """The conditions in their order; one whose column is absent is left out."""
    out = []
    if drop_retweets and "is_retweet" in df.columns:
        out.append(("retweets", ~truthy(F.col("is_retweet"))))
    if drop_quotes and "is_quote" in df.columns:
        out.append(("quotes", ~truthy(F.col("is_quote"))))
    if langs and lang_col in df.columns:
        out.append(("lang", F.coalesce(F.col(lang_col).isin(*langs), F.lit(False))))
    if query_types and type_col in df.columns:
        out.append(("type", F.coalesce(F.col(type_col).isin(*query_types), F.lit(False))))
    if text_col in df.columns:
        out.append(("blank", strip(F.coalesce(F.col(text_col).cast("string"), F.lit(""))) != ""))
    return out


def select(df: DataFrame, **options) -> DataFrame:
    for _, keep in filters(df, **options):
        df = df.where(keep)
    return df


def filter_report(df: DataFrame, **options) -> DataFrame:
    """step, removed by each condition after those before it, in one pass."""
    steps, alive, aggs = filters(df, **options), F.lit(True), []
    for name, keep in steps:
        aggs.append(F.count_if(alive & ~keep).alias(name))
        alive = alive & keep
    one = df.agg(*aggs, F.count_if(alive).alias("kept"))
    names = [n for n, _ in steps] + ["kept"]
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("step"), F.col(n).alias("rows")) for n in names])).alias("r")).select("r.*")


def sample(df: DataFrame, n: int, seed: int, id_col: str = "id") -> DataFrame:
    """Exactly n rows (all for 0), the same for a seed whatever rows join later, by an order of hashes."""
    if n <= 0:
        return df
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"))), id_col).limit(n)


#: What secondary samples add to the seed of a profile, so that they do not repeat the rows of the main sample.
OFFSETS = {"main": 0, "cost": 0, "tokens": 0, "retest": 1, "calibration": 2, "gold": 3}
SIZES = {"cost": 15, "tokens": 60}


def sample_for(df: DataFrame, purpose: str, seed: int, n: int | None = None, id_col: str = "id") -> DataFrame:
    """The sample of a purpose (cost, tokens, retest, calibration, gold) for a profile's seed."""
    return sample(df, SIZES[purpose] if n is None else n, seed + OFFSETS[purpose], id_col)


def by_ids(df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """The rows of an id list, past all filters."""
    wanted = ids.select(F.col(ids.columns[0]).cast("string").alias("__id"))
    return df.join(wanted, F.col(id_col).cast("string") == F.col("__id"), "left_semi")


def absent_ids(df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    wanted = ids.select(F.col(ids.columns[0]).cast("string").alias("id")).distinct()
    return wanted.join(df.select(F.col(id_col).cast("string").alias("__id")), F.col("id") == F.col("__id"), "left_anti")


def marks(df: DataFrame, text_col: str = "text_completo", reply_col: str = "in_reply_to_user_id") -> Column:
    """The marks of a text that does not stand alone."""
    has = lambda c: c in df.columns
    text = safe_text(F.col(text_col))
    reply = (safe_text(F.col(reply_col)) != "") | text.startswith("@") if has(reply_col) else text.startswith("@")
    flag = lambda c: truthy(F.col(c)) if has(c) else F.lit(False)
    return F.array_compact(F.array(F.when(reply, "reply"), F.when(flag("is_retweet"), "retweet"), F.when(flag("is_quote"), "quote")))


def payload(df: DataFrame, text_col: str = "text_completo", lang_col: str = "lang", translation_col: str = "traducción") -> DataFrame:
    """df with _payload and contexto_incompleto."""
    m = F.col("__marks")
    notice = F.array_join(F.transform(m, lambda x: F.create_map(*[F.lit(y) for kv in NOTICES.items() for y in kv])[x]), " ")
    lang = safe_text(F.col(lang_col))
    tweet = F.concat(F.lit('<tweet idioma="'), F.when(lang == "", "desconocido").otherwise(lang), F.lit('">\n'), safe_text(F.col(text_col)), F.lit("\n</tweet>"))
    parts = [F.when(F.size(m) > 0, F.concat(F.lit(NOTICE_HEAD), notice)), tweet]
    if translation_col in df.columns:
        tr = safe_text(F.col(translation_col))
        parts.append(F.when(tr != "", F.concat(F.lit("<traduccion_al_espanol_de_apoyo>\n"), tr, F.lit("\n</traduccion_al_espanol_de_apoyo>"))))
    out = df.withColumn("__marks", marks(df, text_col))
    return out.withColumn("_payload", F.concat_ws("\n\n", *parts)).withColumn("contexto_incompleto", F.array_join("__marks", ";")).drop("__marks")


def payload_report(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.count_if(F.col("contexto_incompleto") != "").alias("incomplete"), F.count_if(F.col("_payload").contains("traduccion_al_espanol")).alias("translated"))
