"""The scoring domain's tables as views of the benchmark tables, and the same views in SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import Period
from ..operators import rubric as R

SLUGS = ("click", "error", "purchase", "signup", "view")
LEVELS = tuple(str(k) for k in range(6))
ABSENCE = {s: ["0"] if s != "view" else [] for s in SLUGS}
ZONE = "America/Mexico_City"
PERIODS = (Period("antes", date(2024, 1, 1), date(2024, 1, 11)), Period("durante", date(2024, 1, 11), date(2024, 1, 21)), Period("despues", date(2024, 1, 21)))
RUBRIC = {"criterios": [{"slug": s, "id_criterio": str(i), "nombre": f"CRITERIO {s.upper()}: DIMENSIÓN", "consigna": f"Califica {s}.", "niveles": [{"etiqueta": x, "puntos": float(x), "descriptor": f"Nivel {x} de {s}"} for x in LEVELS]} for i, s in enumerate(SLUGS, 1)]}
STATE = "CASE k % 10 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'SIN_RESPUESTA' WHEN 2 THEN 'BLOQUEADO' WHEN 3 THEN 'FUERA_DE_ESCALA' WHEN 4 THEN 'NO_APLICABLE' WHEN 5 THEN 'NO_APLICABLE' WHEN 6 THEN 'NO_APLICABLE' ELSE 'OK' END"
DETAIL = "CASE WHEN k % 10 = 0 THEN CASE k % 7 WHEN 0 THEN '429 RESOURCE_EXHAUSTED' WHEN 1 THEN '503 UNAVAILABLE' WHEN 2 THEN 'API key not valid' WHEN 3 THEN 'blocked by safety filter' ELSE 'unknown failure' END WHEN k % 10 = 1 THEN 'no answer' WHEN k % 10 = 3 THEN concat('level ', k % 6, ' is not in the scale') ELSE '' END"
CONTEXT = "CASE k % 4 WHEN 0 THEN 'reply' WHEN 2 THEN 'quote' ELSE '' END"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rubric() -> dict:
    return R.annotate({"criterios": [dict(c) for c in RUBRIC["criterios"]]})


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a score log; the number of rows comes from the files' footers."""
    events = read(spark, sf_dir, "events")
    tweets = max(1, events.count() // 9)
    k = F.get_json_object("props", "$.k").cast("int")
    rows = events.select(F.col("event_id").alias("seq"), F.pmod("event_id", F.lit(tweets)).cast("string").alias("tweet_id"), F.col("event_type").alias("slug"), k.alias("k"), F.col("ts").cast("timestamp").alias("ts"))
    rows = rows.withColumns({"estado": F.expr(STATE), "aplicable": (F.col("k") % 10 == 3) | (F.col("k") % 10 >= 7), "detalle": F.expr(DETAIL), "contexto_incompleto": F.expr(CONTEXT)})
    ok = F.col("estado") == "OK"
    return rows.select("seq", "tweet_id", "slug", "ts", "estado", "aplicable", F.when(ok, (F.col("k") % 6).cast("string")).alias("nivel"), F.when(ok, (F.col("k") % 6).cast("double")).alias("puntaje"), F.concat(F.lit("motivo "), F.col("k").cast("string")).alias("justificacion"), "detalle", "contexto_incompleto")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("text_completo"), "lang", F.col("source").alias("base"))


def translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A translation log over events: several records for some documents."""
    events = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    rows = events.select(F.col("event_id").alias("seq"), F.pmod("user_id", F.lit(1_000_000)).cast("string").alias("tweet_id"), k.alias("k"))
    return rows.select("seq", "tweet_id", F.expr("CASE k % 5 WHEN 0 THEN 'francés' WHEN 1 THEN 'español' ELSE 'inglés' END").alias("idioma_detectado"), (F.col("k") % 5 == 1).alias("ya_esta_en_espanol"), F.concat(F.lit("traducción "), F.col("k").cast("string")).alias("traduccion"), F.expr("CASE WHEN k % 10 = 0 THEN 'FALLIDA' WHEN k % 10 = 9 THEN 'BLOQUEADA' ELSE 'OK' END").alias("estado"))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels")
    return labels.select(F.col("doc_id").cast("string").alias("tweet_id"), F.lit("view").alias("slug"), F.col("quality").cast("string").alias("nivel_humano"))


def selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as rows to score, with the columns that filters and marks look at."""
    c = read(spark, sf_dir, "conversations")
    return c.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), F.col("text").alias("text_completo"), F.when(F.col("conv_id") % 3 == 0, "es").otherwise("fr").alias("lang"), F.col("role").alias("TIPO_QUERY"),
        F.when(F.col("turn") > 0, F.col("conv_id").cast("string")).alias("in_reply_to_user_id"), F.when(F.col("conv_id") % 7 == 0, " true ").otherwise("FALSE").alias("is_retweet"), F.when(F.col("conv_id") % 5 == 0, "si").otherwise("").alias("is_quote"),
        F.when(F.col("turn") % 2 == 1, F.concat(F.lit("traducción de "), F.col("conv_id").cast("string"))).otherwise("nan").alias("traducción"),
    )


_K = """CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER)"""
LOG_SQL = f"""ev AS (SELECT event_id AS seq, CAST(event_id % greatest(1, (SELECT count(*) FROM events) // 9) AS VARCHAR) AS tweet_id, event_type AS slug, {_K} AS k, ts FROM events),
ckpt AS (SELECT seq, tweet_id, slug, ts, {STATE} AS estado, k % 10 = 3 OR k % 10 >= 7 AS aplicable, CASE WHEN k % 10 >= 7 THEN CAST(k % 6 AS VARCHAR) END AS nivel,
  CASE WHEN k % 10 >= 7 THEN CAST(k % 6 AS DOUBLE) END AS puntaje, concat('motivo ', k) AS justificacion, {DETAIL} AS detalle, {CONTEXT} AS contexto_incompleto FROM ev)"""
_RESOLVED = "(SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY tweet_id, slug ORDER BY estado IN ('OK', 'NO_APLICABLE', 'BLOQUEADO') DESC, seq DESC) = 1)"
RES_SQL = f"{LOG_SQL},\nres AS {_RESOLVED.format(src='ckpt')}"
HALVES_SQL = f"{LOG_SQL},\nra AS {_RESOLVED.format(src='(SELECT * FROM ckpt WHERE seq % 2 = 0)')},\nrb AS {_RESOLVED.format(src='(SELECT * FROM ckpt WHERE seq % 2 = 1)')}"
CORPUS_SQL = "corpus AS (SELECT CAST(doc_id AS VARCHAR) AS id, text AS text_completo, lang, source AS base FROM documents)"
LEVELS_SQL = "levels AS (SELECT slug, CAST(o AS VARCHAR) AS nivel, o::INTEGER AS ordinal, CAST(o AS DOUBLE) AS puntos FROM (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS slug), (SELECT unnest(range(6)) AS o))"
_DAY = f"CAST(timezone('{ZONE}', timezone('UTC', ts)) AS DATE)"
READY_SQL = f"""{RES_SQL},
{CORPUS_SQL},
ready AS (SELECT r.*, {_DAY} AS dia, strftime({_DAY}, '%Y-%m-%d') AS fecha, CASE WHEN trim(coalesce(c.lang, '')) = '' THEN '(sin idioma)' ELSE trim(c.lang) END AS idioma, contexto_incompleto = '' AS autosuficiente,
  CASE WHEN {_DAY} >= DATE '2024-01-01' AND {_DAY} < DATE '2024-01-11' THEN 'antes' WHEN {_DAY} >= DATE '2024-01-11' AND {_DAY} < DATE '2024-01-21' THEN 'durante' WHEN {_DAY} >= DATE '2024-01-21' THEN 'despues' END AS periodo
  FROM res r JOIN corpus c ON r.tweet_id = c.id)"""
CUBE_SQL = f"""{READY_SQL},
cl AS (SELECT *, CASE WHEN estado = 'OK' AND slug <> 'view' AND nivel = '0' THEN 'ausencia' WHEN estado = 'OK' THEN 'valencia' WHEN estado = 'NO_APLICABLE' THEN 'ausencia' ELSE 'fallida' END AS clase FROM ready),
cube AS (SELECT fecha, slug, clase, CASE WHEN clase = 'valencia' THEN nivel ELSE '' END AS nivel, idioma, autosuficiente, count(*) AS n FROM cl GROUP BY ALL),
daily AS (SELECT fecha, slug, coalesce(sum(n) FILTER (clase = 'valencia'), 0)::BIGINT AS con_valencia, coalesce(sum(n) FILTER (clase = 'ausencia'), 0)::BIGINT AS ausencia, coalesce(sum(n) FILTER (clase = 'fallida'), 0)::BIGINT AS fallida FROM cube GROUP BY fecha, slug),
sal AS (SELECT fecha, slug, con_valencia, con_valencia + ausencia AS base, round(con_valencia / nullif(con_valencia + ausencia, 0), 6) AS salience FROM daily)"""
TR_SQL = f"""te AS (SELECT event_id AS seq, CAST(user_id % 1000000 AS VARCHAR) AS tweet_id, {_K} AS k FROM events),
tr AS (SELECT seq, tweet_id, CASE k % 5 WHEN 0 THEN 'francés' WHEN 1 THEN 'español' ELSE 'inglés' END AS idioma_detectado, k % 5 = 1 AS ya_esta_en_espanol, concat('traducción ', k) AS traduccion, CASE WHEN k % 10 = 0 THEN 'FALLIDA' WHEN k % 10 = 9 THEN 'BLOQUEADA' ELSE 'OK' END AS estado FROM te),
last AS (SELECT * FROM tr QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY seq DESC) = 1),
{CORPUS_SQL}"""
SEL_SQL = """sel AS (SELECT concat(conv_id, '-', turn) AS id, text AS text_completo, CASE WHEN conv_id % 3 = 0 THEN 'es' ELSE 'fr' END AS lang, role AS tipo, turn > 0 AS reply, conv_id % 7 = 0 AS rt, conv_id % 5 = 0 AS qt,
  CASE WHEN turn % 2 = 1 THEN concat('traducción de ', conv_id) END AS trad FROM conversations)"""
