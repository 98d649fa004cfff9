"""The registered queries of the scoring analytics, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import time
from ..functions.time import Period
from ..operators import export, keys, log, quality, repair, rubric, scoring, select, temporal, translate
from ..sources import logs
from . import views as V

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
_INSTRUCTIONS = {c["slug"]: rubric.instruction(c) for c in V.rubric()["criterios"]}


def query(name: str, sql: str | None = None):
    def add(f):
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    return log.resolve(V.log(spark, d))


def _halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = V.log(spark, d)
    return log.resolve(rows.where("seq % 2 = 0")), log.resolve(rows.where("seq % 2 = 1"))


def _ready(spark: SparkSession, d: str) -> DataFrame:
    return temporal.prepare(_resolved(spark, d), V.corpus(spark, d), "ts", V.ZONE, V.PERIODS, ts_in_corpus=False)


def _cube(spark: SparkSession, d: str) -> DataFrame:
    return temporal.cube(_ready(spark, d), V.ABSENCE)


_LEVELS = {s: list(V.LEVELS) for s in V.SLUGS}
_RES = "('OK', 'NO_APLICABLE', 'BLOQUEADO')"

# ------------------------------------------------------------------------------------------- log


@query("ckpt_last_valid", f"WITH {V.RES_SQL} SELECT seq, tweet_id, slug, estado, aplicable, nivel, puntaje, justificacion, detalle, contexto_incompleto FROM res")
def _(spark, d):
    return log.resolve(V.log(spark, d).drop("ts")).select("seq", "tweet_id", "slug", "estado", "aplicable", "nivel", "puntaje", "justificacion", "detalle", "contexto_incompleto")


for _name, _scope, _states in (("ckpt_done_fallidos", "fallidos", _RES), ("ckpt_done_sin_nivel", "sin-nivel", "('OK')")):
    _QUERIES[_name] = lambda spark, d, s=_scope: log.done(V.log(spark, d), s)
    _SQL[_name] = f"WITH {V.RES_SQL} SELECT tweet_id, slug FROM ckpt WHERE estado IN {_states} GROUP BY ALL"

for _name, _scope, _cond in (("ckpt_pending_todo", "todo", "FALSE"), ("ckpt_pending_fallidos", "fallidos", f"estado IN {_RES}")):
    _QUERIES[_name] = lambda spark, d, s=_scope: log.pending(V.corpus(spark, d), V.SLUGS, V.log(spark, d), s)
    _SQL[_name] = f"WITH {V.LOG_SQL}, {V.CORPUS_SQL} SELECT id AS tweet_id, slug FROM corpus, (SELECT unnest({list(V.SLUGS)}) AS slug) s WHERE NOT EXISTS (SELECT 1 FROM ckpt WHERE ckpt.tweet_id = corpus.id AND ckpt.slug = s.slug AND {_cond})"


@query("ckpt_audit", f"""WITH {V.LOG_SQL}, p AS (SELECT tweet_id, slug, count(*) AS n, bool_or(estado IN {_RES}) AS ok FROM ckpt GROUP BY ALL)
SELECT sum(n)::BIGINT AS records, 0::BIGINT AS unreadable, count(*) AS pairs, count(DISTINCT tweet_id) AS tweets, count(DISTINCT slug) AS criteria, count(*) FILTER (n > 1) AS repeated, max(n)::BIGINT AS most, count(*) FILTER (ok) AS resolved, count(*) FILTER (NOT ok) AS failed FROM p""")  # fmt: skip
def _(spark, d):
    return log.audit(V.log(spark, d))


@query("ckpt_state_histogram", f"WITH {V.RES_SQL} SELECT estado, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM res GROUP BY estado")
def _(spark, d):
    return log.state_histogram(V.log(spark, d))


@query("ckpt_top_failures", f"WITH {V.LOG_SQL} SELECT estado, left(detalle, 110) AS diagnostico, count(*) AS n FROM ckpt WHERE estado NOT IN {_RES} AND detalle <> '' GROUP BY ALL ORDER BY n DESC, estado, diagnostico LIMIT 5")
def _(spark, d):
    return log.top_failures(V.log(spark, d))


@query("ckpt_rescore_estimate", f"""WITH {V.LOG_SQL}, {V.CORPUS_SQL}, b AS (SELECT tweet_id, slug, max(CASE WHEN estado = 'OK' THEN 2 WHEN estado IN {_RES} THEN 1 ELSE 0 END) AS best FROM ckpt GROUP BY ALL),
p AS (SELECT coalesce(best, 0) AS best FROM (SELECT id AS tweet_id, slug FROM corpus, (SELECT unnest({list(V.SLUGS)}) AS slug)) LEFT JOIN b USING (tweet_id, slug)),
t AS (SELECT unnest(['fallidos', 'sin-nivel', 'todo']) AS scope, unnest([1, 2, 3]) AS need)
SELECT scope, count(*) AS total, count(*) FILTER (best >= need) AS recovered, count(*) FILTER (best < need) AS to_score FROM p, t GROUP BY scope""")  # fmt: skip
def _(spark, d):
    return log.rescore_estimate(V.corpus(spark, d), V.SLUGS, V.log(spark, d))


@query("ckpt_failure_streaks", f"""WITH {V.LOG_SQL}, g AS (SELECT seq, estado IN {_RES} AS good, sum((estado IN {_RES})::INT) OVER (ORDER BY seq) AS island FROM ckpt)
SELECT min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS length FROM g WHERE NOT good GROUP BY island HAVING count(*) >= 2""")  # fmt: skip
def _(spark, d):
    return log.failure_streaks(V.log(spark, d))


@query("ckpt_failure_streaks_by_criterion", f"""WITH {V.LOG_SQL}, g AS (SELECT slug, seq, estado IN {_RES} AS good, sum((estado IN {_RES})::INT) OVER (PARTITION BY slug ORDER BY seq) AS island FROM ckpt)
SELECT slug, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS length FROM g WHERE NOT good GROUP BY slug, island HAVING count(*) >= 2""")  # fmt: skip
def _(spark, d):
    return log.failure_streaks(V.log(spark, d), by="slug")


@query("ckpt_row_streaks", f"""WITH {V.LOG_SQL}, r AS (SELECT tweet_id, max(seq) AS seq, bool_or(estado IN {_RES}) AS good FROM ckpt GROUP BY tweet_id), g AS (SELECT seq, good, sum(good::INT) OVER (ORDER BY seq) AS island FROM r)
SELECT min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS length FROM g WHERE NOT good GROUP BY island HAVING count(*) >= 1""")  # fmt: skip
def _(spark, d):
    return log.row_streaks(V.log(spark, d), 1)


@query("ckpt_unreadable", "SELECT count(*) FILTER (event_id % 13 = 0 OR event_id % 11 = 0) AS unreadable, count(*) FILTER (event_id % 13 <> 0 AND event_id % 11 <> 0) AS readable FROM events")
def _(spark, d):
    rows = V.log(spark, d).drop("ts")
    whole = F.to_json(F.struct(*[F.col(c) if c != "slug" else F.when(F.col("seq") % 11 != 0, F.col("slug")).alias("slug") for c in rows.columns]))
    lines = rows.select(F.when(F.col("seq") % 13 == 0, F.substring(whole, 1, 20)).otherwise(whole).alias("value"))
    lines = lines.unionByName(lines.limit(3).select(F.lit("  ").alias("value")))
    return logs.judged_lines(lines).agg(F.count_if(~F.col("readable")).alias("unreadable"), F.count_if("readable").alias("readable"))


@query("ckpt_run_totals", f"WITH {V.LOG_SQL} SELECT count(*) FILTER (estado IN {_RES}) AS ok, count(*) FILTER (estado NOT IN {_RES}) AS failed, (SELECT count(*) FROM documents) * {len(V.SLUGS)} - count(*) AS reused FROM ckpt WHERE seq % 3 = 0")
def _(spark, d):
    return scoring.run_totals(V.log(spark, d).where("seq % 3 = 0"), V.corpus(spark, d).count() * len(V.SLUGS))


@query("ckpt_failure_classify", f"""WITH {V.LOG_SQL} SELECT seq, CASE WHEN lower(detalle) LIKE '%api key not valid%' THEN 'PERMANENTE' WHEN lower(detalle) LIKE '%safety%' OR lower(detalle) LIKE '%blocked%' THEN 'BLOQUEADO'
WHEN lower(detalle) LIKE '%429%' OR lower(detalle) LIKE '%resource_exhausted%' THEN 'LIMITE_TASA' WHEN lower(detalle) LIKE '%503%' OR lower(detalle) LIKE '%unavailable%' THEN 'ERROR_SERVIDOR' ELSE 'ERROR' END AS clase FROM ckpt WHERE detalle <> ''""")  # fmt: skip
def _(spark, d):
    return V.log(spark, d).where("detalle <> ''").select("seq", X.failure_class(F.col("detalle")).alias("clase"))


@query("ckpt_slug_diff", "SELECT 'view' AS slug, 'log' AS side UNION ALL SELECT 'nuevo', 'rubric'")
def _(spark, d):
    return log.slug_difference(V.log(spark, d), [*V.SLUGS[:-1], "nuevo"])


# ---------------------------------------------------------------------------------------- repair


@query("repair_mojibake_roundtrip", "SELECT doc_id, text FROM documents")
def _(spark, d):
    return V.read(spark, d, "documents").select("doc_id", X.unmangled(repair.mangled(F.col("text"))).alias("text"))


@query("repair_loss_detector", "SELECT count(*) AS rows, count(*) FILTER (regexp_matches(t, '[\\x{80}-ÿ]\\?|\\?[\\x{80}-ÿ]')) AS lossy, round(count(*) FILTER (regexp_matches(t, '[\\x{80}-ÿ]\\?|\\?[\\x{80}-ÿ]')) / greatest(count(*), 1), 6) AS share FROM (SELECT replace(text, 'é', 'Ã?') AS t FROM documents)")
def _(spark, d):
    docs = V.read(spark, d, "documents").select(F.replace("text", F.lit("é"), F.lit("Ã?")).alias("text"))
    return repair.loss_share(docs)


def _raw(spark, d) -> DataFrame:
    """Flat rows cut to 255 characters without line ends, beside the documents they come from."""
    docs = V.read(spark, d, "documents")
    doc = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), "lang", "text", F.struct(F.col("source").alias("username"), F.lit(True).alias("verified"), F.struct((F.col("n_chars") * 2).alias("followers_count")).alias("public_metrics")).alias("_author"), F.struct(F.col("n_chars").alias("like_count")).alias("public_metrics"), F.concat(F.lit("2024-01-01T00:00:00"), F.lit(".000Z")).alias("created_at")))
    flat = F.substring(F.replace("text", F.lit("\n"), F.lit(" ")), 1, 255)
    cols = {"id": F.concat(F.lit("1"), F.col("doc_id").cast("string")), "lang": F.lit(""), "text": flat, "like_count": F.lit(""), "author_username": F.lit("x"), "author_verified": F.lit(""), "author_followers_count": F.lit(""), "entities": F.lit("x"), "referenced_tweets": F.lit("x"), "created_at": F.lit("")}
    return docs.select("doc_id", *[c.alias(n) for n, c in cols.items()], doc.alias("raw_json"))


@query("repair_from_json", """SELECT doc_id::VARCHAR AS doc_id, doc_id::VARCHAR AS id, lang, text, n_chars::VARCHAR AS like_count, source AS author_username, 'True' AS author_verified, (n_chars * 2)::VARCHAR AS author_followers_count, '' AS entities, '[]' AS referenced_tweets, '2024-01-01T00:00:00' AS created_at FROM documents""")
def _(spark, d):
    src = _raw(spark, d)
    return repair.repaired(src.withColumn("doc_id", F.col("doc_id").cast("string"))).drop("raw_json")


@query("repair_report", """SELECT count(*) AS rows, count(*) AS id_changed, count(*) FILTER (length(text) > 255) AS untruncated, count(*) FILTER (contains(text, chr(10))) AS line_ends,
(count(*) FILTER (left(replace(text, chr(10), ' '), 255) <> text) + count(*) FILTER (source <> 'x'))::BIGINT AS fields_repaired, count(*) FILTER (regexp_matches(text, '[\\x{80}-ÿ]\\?|\\?[\\x{80}-ÿ]')) AS fields_lossy FROM documents""")  # fmt: skip
def _(spark, d):
    src = _raw(spark, d).select("doc_id", "id", "text", F.col("author_username").alias("author_name"), "raw_json")
    fixed = repair.repaired(src.withColumn("doc_id", F.col("doc_id").cast("string")))
    fixed = fixed.withColumn("author_name", F.get_json_object("raw_json", "$._author.username"))
    return repair.report(src.withColumn("doc_id", F.col("doc_id").cast("string")), fixed, "doc_id")


# ------------------------------------------------------------------------------------------ keys


def _keyed(spark, d) -> DataFrame:
    docs = V.read(spark, d, "documents")
    real = F.concat(F.lit("2"), F.lpad(F.col("doc_id").cast("string"), 18, "0"))
    flat = F.when(F.col("doc_id") % 3 == 0, real).when(F.col("doc_id") % 3 == 1, "2.06E+18").otherwise("")
    raw = F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit('{"id": "'), real, F.lit('"}'))).otherwise("")
    return docs.select("doc_id", flat.alias("id"), raw.alias("raw_json"), F.col("source").alias("author_username"), F.col("doc_id").cast("string").alias("created_at"), "text", "lang")


_KEYS = """kx AS (SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN '2' || lpad(doc_id::VARCHAR, 18, '0') ELSE 'local:' || left(sha256(concat_ws(chr(31), source, doc_id::VARCHAR, text)), 16) END AS id,
CASE doc_id % 3 WHEN 0 THEN 'flat' WHEN 1 THEN 'json' ELSE 'synthetic' END AS key_source, lang FROM documents)"""


@query("keys_resolve", f"WITH {_KEYS} SELECT doc_id, id, key_source FROM kx")
def _(spark, d):
    return keys.resolved(_keyed(spark, d)).select("doc_id", "id", "key_source")


@query("consolidate_union", f"WITH {_KEYS} SELECT id, lang, CASE WHEN doc_id % 4 < 3 THEN doc_id::VARCHAR ELSE '' END AS nota FROM kx")
def _(spark, d):
    all_ = keys.resolved(_keyed(spark, d))
    base = all_.where("doc_id % 4 < 3").select("id", "lang", F.col("doc_id").cast("string").alias("nota"))
    return keys.consolidated(base, all_.where("doc_id % 4 > 1").select("id", "lang", "text"))


@query("consolidate_integrity", f"WITH {_KEYS}, u AS (SELECT id FROM kx UNION ALL SELECT id FROM kx WHERE doc_id % 10 = 0), g AS (SELECT id, count(*) AS n FROM u GROUP BY id) SELECT sum(n)::BIGINT AS rows, count(*) AS keys, count(*) FILTER (n > 1) AS repeated, count(*) FILTER (id LIKE 'local:%') AS synthetic, 0::BIGINT AS malformed FROM g")
def _(spark, d):
    k = keys.resolved(_keyed(spark, d))
    return keys.integrity(k.select("id").unionByName(k.where("doc_id % 10 = 0").select("id")))


# ------------------------------------------------------------------------------------- selection

_KEEP = "NOT rt AND NOT qt AND lang IN ('fr') AND tipo IN ('user')"


@query("select_filters", f"WITH {V.SEL_SQL} SELECT id FROM sel WHERE {_KEEP} AND trim(text_completo) <> ''")
def _(spark, d):
    return select.select(V.selection(spark, d), langs=["fr"], query_types=["user"]).select("id")


@query("select_filter_report", f"""WITH {V.SEL_SQL} SELECT unnest(['retweets', 'quotes', 'lang', 'type', 'blank', 'kept']) AS step, unnest([count(*) FILTER (rt), count(*) FILTER (NOT rt AND qt), count(*) FILTER (NOT rt AND NOT qt AND lang <> 'fr'),
count(*) FILTER (NOT rt AND NOT qt AND lang = 'fr' AND tipo <> 'user'), count(*) FILTER ({_KEEP} AND trim(text_completo) = ''), count(*) FILTER ({_KEEP} AND trim(text_completo) <> '')]) AS rows FROM sel""")  # fmt: skip
def _(spark, d):
    return select.filter_report(V.selection(spark, d), langs=["fr"], query_types=["user"])


@query("select_sample", f"WITH {V.SEL_SQL} SELECT id FROM sel ORDER BY md5('42:' || id), id LIMIT 60")
def _(spark, d):
    return select.sample(V.selection(spark, d), 60, 42).select("id")


@query("select_by_ids", f"WITH {V.LOG_SQL}, {V.CORPUS_SQL} SELECT id, lang FROM corpus WHERE id IN (SELECT tweet_id FROM ckpt WHERE estado = 'ERROR')")
def _(spark, d):
    return select.by_ids(V.corpus(spark, d), V.log(spark, d).where("estado = 'ERROR'").select("tweet_id").distinct()).select("id", "lang")


@query("select_absent_ids", f"WITH {V.LOG_SQL}, {V.CORPUS_SQL} SELECT DISTINCT tweet_id AS id FROM ckpt WHERE tweet_id NOT IN (SELECT id FROM corpus)")
def _(spark, d):
    return select.absent_ids(V.corpus(spark, d), V.log(spark, d).select("tweet_id"))


_MARKS = "concat_ws(';', CASE WHEN reply OR trim(text_completo) LIKE '@%' THEN 'reply' END, CASE WHEN rt THEN 'retweet' END, CASE WHEN qt THEN 'quote' END)"


@query("context_marks", f"WITH {V.SEL_SQL} SELECT id, {_MARKS} AS contexto_incompleto FROM sel")
def _(spark, d):
    s = V.selection(spark, d)
    return s.select("id", F.array_join(select.marks(s), ";").alias("contexto_incompleto"))


@query("payload_report", f"WITH {V.SEL_SQL}, m AS (SELECT *, {_MARKS} AS contexto_incompleto FROM sel) SELECT count(*) AS rows, count(*) FILTER (contexto_incompleto <> '') AS incomplete, count(*) FILTER (trad IS NOT NULL) AS translated FROM m")
def _(spark, d):
    return select.payload_report(select.payload(V.selection(spark, d)))


@query("payload_build", f"""WITH {V.SEL_SQL}, m AS (SELECT *, {_MARKS} AS contexto_incompleto FROM sel)
SELECT id, contexto_incompleto, concat_ws(chr(10) || chr(10),
 CASE WHEN contexto_incompleto <> '' THEN '{select.NOTICE_HEAD}' || concat_ws(' ', CASE WHEN contains(contexto_incompleto, 'reply') THEN '{select.NOTICES["reply"]}' END, CASE WHEN contains(contexto_incompleto, 'retweet') THEN '{select.NOTICES["retweet"]}' END, CASE WHEN contains(contexto_incompleto, 'quote') THEN '{select.NOTICES["quote"]}' END) END,
 '<tweet idioma="' || lang || '">' || chr(10) || regexp_replace(text_completo, '^\\s+|\\s+$', '', 'g') || chr(10) || '</tweet>',
 CASE WHEN trad IS NOT NULL THEN '<traduccion_al_espanol_de_apoyo>' || chr(10) || trad || chr(10) || '</traduccion_al_espanol_de_apoyo>' END) AS _payload FROM m""")  # fmt: skip
def _(spark, d):
    return select.payload(V.selection(spark, d)).select("id", "contexto_incompleto", "_payload")


# --------------------------------------------------------------------------------------- scoring

_RAW_SQL = f"""{V.LOG_SQL}, raw AS (SELECT seq, tweet_id, slug, k % 10 > 3 AS aplicable, CASE WHEN k % 10 = 4 THEN NULL WHEN k % 10 = 5 THEN '9' WHEN k % 10 < 8 THEN '  "' || (k % 6) || '" ' ELSE (k % 6)::VARCHAR END AS nivel, k FROM ev)"""


@query("score_validate", f"""WITH {_RAW_SQL} SELECT seq, tweet_id, slug, aplicable, CASE WHEN k % 10 > 5 THEN (k % 6)::VARCHAR END AS nivel, CASE WHEN k % 10 > 5 THEN (k % 6)::DOUBLE END AS puntaje, 'j' AS justificacion,
CASE WHEN NOT aplicable THEN 'NO_APLICABLE' WHEN k % 10 < 6 THEN 'FUERA_DE_ESCALA' ELSE 'OK' END AS estado, CASE WHEN k % 10 = 4 THEN 'nivel devuelto None no está en la escala del criterio' WHEN k % 10 = 5 THEN 'nivel devuelto ''9'' no está en la escala del criterio' ELSE '' END AS detalle FROM raw""")  # fmt: skip
def _(spark, d):
    r = V.log(spark, d).withColumn("k", F.regexp_extract("justificacion", "([0-9]+)", 1).cast("int"))
    level = F.expr("CASE WHEN k % 10 = 4 THEN NULL WHEN k % 10 = 5 THEN '9' WHEN k % 10 < 8 THEN concat('  \"', k % 6, '\" ') ELSE cast(k % 6 AS string) END")
    raw = r.select("seq", "tweet_id", "slug", F.expr("k % 10 > 3").alias("aplicable"), level.alias("nivel"), F.lit(" j ").alias("justificacion"))
    return scoring.validate(raw, rubric.levels(spark, V.rubric()))


_LENGTHS = " + ".join(f"floor((length(_payload) + {len(i)}) / 4)" for i in _INSTRUCTIONS.values())


@query("score_cost_estimate", f"""WITH {V.CORPUS_SQL}, p AS (SELECT text_completo AS _payload FROM corpus), c AS (SELECT count(*) AS rows, avg(({_LENGTHS}) / {len(V.SLUGS)}) AS t FROM p)
SELECT rows, rows * {len(V.SLUGS)} AS calls, round(t, 6) AS tokens_in, round(rows * {len(V.SLUGS)} * t / 1e6 * 0.3 + rows * {len(V.SLUGS)} * {scoring.output_tokens()} / 1e6 * 2.5, 6) AS cost FROM c""")  # fmt: skip
def _(spark, d):
    return scoring.cost(V.corpus(spark, d).select(F.col("text_completo").alias("_payload")), list(_INSTRUCTIONS.values()), 0.3, 2.5)


def _stub(payload: str, slug: str, instruction: str) -> dict:
    n = len(payload)
    if n % 11 == 0:
        raise RuntimeError("503 UNAVAILABLE")
    return {"aplicable": n % 3 > 0, "nivel": str(n % 7), "justificacion": "stub"}


def _no_wait(attempt: int) -> None:
    """The stub needs no rest."""


@query("score_run_stub", f"""WITH {V.SEL_SQL}, w AS (SELECT id AS tweet_id, slug, length(text_completo) AS n FROM sel, (SELECT unnest({list(V.SLUGS)}) AS slug))
SELECT tweet_id, slug, n % 11 <> 0 AND n % 3 > 0 AS aplicable, CASE WHEN n % 11 <> 0 AND n % 3 > 0 AND n % 7 < 6 THEN (n % 7)::VARCHAR END AS nivel, CASE WHEN n % 11 <> 0 AND n % 3 > 0 AND n % 7 < 6 THEN (n % 7)::DOUBLE END AS puntaje,
CASE WHEN n % 11 = 0 THEN 'ERROR_SERVIDOR' WHEN n % 3 = 0 THEN 'NO_APLICABLE' WHEN n % 7 = 6 THEN 'FUERA_DE_ESCALA' ELSE 'OK' END AS estado FROM w""")  # fmt: skip
def _(spark, d):
    s = V.selection(spark, d).select(F.col("id").alias("tweet_id"), F.col("text_completo").alias("_payload"), F.lit("").alias("contexto_incompleto"))
    work = s.select("*", F.explode(F.array(*[F.lit(x) for x in V.SLUGS])).alias("slug"))
    return scoring.score(work, _INSTRUCTIONS, [_stub], rubric.levels(spark, V.rubric()), wait=_no_wait).select("tweet_id", "slug", "aplicable", "nivel", "puntaje", "estado")


def _blocked(payload: str, slug: str, instruction: str) -> dict:
    raise RuntimeError("response blocked" if len(payload) % 2 else "429 quota")


@query("score_run_fallback", f"""WITH {V.SEL_SQL}, w AS (SELECT id AS tweet_id, length(text_completo) AS n FROM sel)
SELECT tweet_id, 'click' AS slug, CASE WHEN n % 11 = 0 THEN 'ERROR_SERVIDOR' WHEN n % 3 = 0 THEN 'NO_APLICABLE' WHEN n % 7 = 6 THEN 'FUERA_DE_ESCALA' ELSE 'OK' END AS estado,
CASE WHEN n % 11 = 0 THEN 'respaldo directo: RuntimeError: 503 UNAVAILABLE' ELSE CASE WHEN n % 3 > 0 AND n % 7 = 6 THEN 'nivel devuelto ''6'' no está en la escala del criterio' ELSE '' END || ' (resuelto por respaldo directo)' END AS detalle,
CASE WHEN n % 11 = 0 THEN '' ELSE 'stub' END AS justificacion FROM w""")  # fmt: skip
def _(spark, d):
    work = V.selection(spark, d).select(F.col("id").alias("tweet_id"), F.col("text_completo").alias("_payload"), F.lit("").alias("contexto_incompleto"), F.lit("click").alias("slug"))
    got = scoring.score(work, _INSTRUCTIONS, [_blocked, _stub], rubric.levels(spark, V.rubric()), wait=_no_wait)
    return got.select("tweet_id", "slug", "estado", "detalle", "justificacion")


# ----------------------------------------------------------------------------------- translation


@query("translate_targets", f"WITH {V.TR_SQL} SELECT id, last.tweet_id IS NOT NULL AS retry FROM corpus LEFT JOIN last ON id = tweet_id WHERE trim(text_completo) <> '' AND coalesce(estado <> 'OK', TRUE)")
def _(spark, d):
    return translate.targets(V.corpus(spark, d), V.translations(spark, d)).select("id", "retry")


@query("translate_merge", f"WITH {V.TR_SQL} SELECT id, CASE WHEN estado = 'OK' AND ya_esta_en_espanol THEN text_completo WHEN estado = 'OK' THEN traduccion ELSE '' END AS traduccion FROM corpus LEFT JOIN last ON id = tweet_id")
def _(spark, d):
    return translate.merged(V.corpus(spark, d), V.translations(spark, d)).select("id", F.col("traducción").alias("traduccion"))


_OLD = "CASE WHEN CAST(id AS BIGINT) % 4 = 0 THEN 'vieja' ELSE '' END"


@query("translate_fill_report", f"""WITH {V.TR_SQL}, c AS (SELECT id, {_OLD} AS old, trim(text_completo) <> '' AS has_text FROM corpus), j AS (SELECT c.*, estado, ya_esta_en_espanol FROM c LEFT JOIN last ON id = tweet_id), t AS (SELECT *, has_text AND old = '' AS target FROM j)
SELECT count(*) AS rows, count(*) FILTER (target AND estado = 'OK' AND NOT ya_esta_en_espanol) AS translated, count(*) FILTER (target AND estado = 'OK' AND ya_esta_en_espanol) AS copied, count(*) FILTER (target AND estado <> 'OK') AS failed,
count(*) FILTER (old <> '' OR (target AND estado = 'OK')) AS filled FROM t""")  # fmt: skip
def _(spark, d):
    return translate.fill_report(V.corpus(spark, d).withColumn("traducción", F.expr(_OLD)), V.translations(spark, d))


@query("translate_again", f"""WITH {V.TR_SQL} SELECT id, CASE WHEN trim(text_completo) = '' OR coalesce(estado <> 'OK', TRUE) THEN {_OLD} WHEN ya_esta_en_espanol THEN text_completo ELSE traduccion END AS traduccion FROM corpus LEFT JOIN last ON id = tweet_id""")
def _(spark, d):
    got = translate.merged(V.corpus(spark, d).withColumn("traducción", F.expr(_OLD)), V.translations(spark, d), again=True)
    return got.select("id", F.col("traducción").alias("traduccion"))


@query("tokens_preserved", r"""WITH t AS (SELECT doc_id::VARCHAR AS id, list_distinct(regexp_extract_all(text, 'https?://\S+|[@#][\p{L}\p{N}\p{M}_]+')) AS o, regexp_extract_all(replace(replace(text, '@', ''), 'http', 'h'), 'https?://\S+|[@#][\p{L}\p{N}\p{M}_]+') AS n FROM documents)
SELECT id, array_to_string(list_sort([x FOR x IN o IF NOT list_contains(n, x)]), ' ') AS missing FROM t WHERE len([x FOR x IN o IF NOT list_contains(n, x)]) > 0""")  # fmt: skip
def _(spark, d):
    c = V.corpus(spark, d).withColumn("traducción", F.replace(F.replace("text_completo", F.lit("@"), F.lit("")), F.lit("http"), F.lit("h")))
    return translate.lost_tokens(c).select("id", F.array_join("missing", " ").alias("missing"))


_ALIAS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in X.LANGUAGE_NAMES.items())
_CONTRAST = f"{V.TR_SQL}, cmp AS (SELECT lower(trim(coalesce(lang, ''))) AS lang, lower(trim(idioma_detectado)) AS detectado, CASE lower(trim(lang)) {_ALIAS} ELSE lower(trim(lang)) END = lower(trim(idioma_detectado)) AS agrees FROM corpus JOIN last ON id = tweet_id WHERE estado = 'OK')"


@query("lang_contrast", f"WITH {_CONTRAST} SELECT count(*) AS rows, count(*) FILTER (agrees) AS agree, round(count(*) FILTER (agrees) / nullif(count(*), 0), 6) AS share FROM cmp")
def _(spark, d):
    return translate.language_contrast(V.corpus(spark, d), V.translations(spark, d))


@query("lang_disagreements", f"WITH {_CONTRAST} SELECT lang, detectado, count(*) AS n FROM cmp WHERE NOT agrees GROUP BY ALL ORDER BY n DESC, lang, detectado LIMIT 5")
def _(spark, d):
    return translate.disagreements(V.corpus(spark, d), V.translations(spark, d))


@query("lang_no_language_codes", f"WITH {_CONTRAST}, u AS (SELECT CASE lang WHEN 'fr' THEN 'und' WHEN 'de' THEN 'qme' ELSE lang END AS lang, detectado FROM cmp), g AS (SELECT lang, detectado, count(*) AS n FROM u WHERE lang IN ('und', 'qme') GROUP BY ALL) SELECT lang, detectado, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, detectado)::INTEGER AS rank FROM g QUALIFY rank <= 4")
def _(spark, d):
    c = V.corpus(spark, d).withColumn("lang", F.when(F.col("lang") == "fr", "und").when(F.col("lang") == "de", "qme").otherwise(F.col("lang")))
    return translate.detected_for_codes(c, V.translations(spark, d))


# --------------------------------------------------------------------------------------- quality


@query("quality_distribution", f"""WITH {V.RES_SQL}, {V.LEVELS_SQL}, b AS (SELECT slug, count(*) AS total, count(*) FILTER (estado = 'OK') AS ok, count(*) FILTER (estado = 'NO_APLICABLE') AS na FROM res GROUP BY slug),
c AS (SELECT slug, nivel, count(*) AS n FROM res WHERE estado = 'OK' GROUP BY ALL), g AS (SELECT slug, nivel, coalesce(n, 0)::BIGINT AS n, greatest(ok, 1) AS ok, greatest(total, 1) AS total, na FROM levels LEFT JOIN c USING (slug, nivel) LEFT JOIN b USING (slug)),
h AS (SELECT slug, nivel, n, round(n / ok, 6) AS share, round(max(n) OVER (PARTITION BY slug) / ok, 6) AS top_share, round(na / total, 6) AS na_share FROM g) SELECT *, top_share > 0.9 OR na_share > 0.5 AS alert FROM h""")  # fmt: skip
def _(spark, d):
    return quality.distribution(_resolved(spark, d), rubric.levels(spark, V.rubric()))


@query("quality_failure_reasons", f"WITH {V.RES_SQL} SELECT slug, estado, count(*) AS n FROM res WHERE estado NOT IN ('OK', 'NO_APLICABLE') GROUP BY ALL")
def _(spark, d):
    return quality.failure_reasons(_resolved(spark, d))


_PAIRS = f"{V.HALVES_SQL}, j AS (SELECT ra.tweet_id, ra.slug, ra.nivel AS a, rb.nivel AS b FROM ra JOIN rb USING (tweet_id, slug))"


@query("quality_retest", f"WITH {_PAIRS}, g AS (SELECT coalesce(slug, '(global)') AS slug, count(*) AS n, round(avg((a IS NOT DISTINCT FROM b)::INT), 6) AS agreement FROM j GROUP BY GROUPING SETS ((slug), ())) SELECT *, agreement >= 0.95 AS stable FROM g")
def _(spark, d):
    return quality.retest(*_halves(spark, d))


@query("quality_intermodel", f"WITH {_PAIRS}, g AS (SELECT slug, count(*) AS n, round(avg((a IS NOT DISTINCT FROM b)::INT), 6) AS exact, round(avg(coalesce(abs(a::INT - b::INT) <= 1, FALSE)::INT), 6) AS within_one FROM j GROUP BY slug) SELECT *, exact < 0.6 AS unstable FROM g")
def _(spark, d):
    return quality.inter_model(*_halves(spark, d), rubric.levels(spark, V.rubric()))


_GOLD = f"{V.RES_SQL}, gj AS (SELECT tweet_id, slug, quality::VARCHAR AS humano, nivel, coalesce(nivel = quality::VARCHAR, FALSE) AS same FROM res JOIN labels ON tweet_id = doc_id::VARCHAR AND slug = 'view')"


@query("quality_gold", f"WITH {_GOLD} SELECT slug, count(*) AS n, round(avg(same::INT), 6) AS agreement, round(avg(same::INT), 6) >= 0.7 AS ok FROM gj GROUP BY slug")
def _(spark, d):
    return quality.gold_agreement(_resolved(spark, d), V.gold(spark, d))


@query("quality_gold_disagreements", f"WITH {_GOLD} SELECT tweet_id, slug, humano, nivel FROM gj WHERE NOT same ORDER BY slug, tweet_id LIMIT 15")
def _(spark, d):
    return quality.gold_disagreements(_resolved(spark, d), V.gold(spark, d))


@query("quality_gold_template", f"WITH {V.CORPUS_SQL}, s AS (SELECT * FROM corpus ORDER BY md5('45:' || id), id LIMIT 50) SELECT id AS tweet_id, text_completo AS texto, slug, concat('CRITERIO ', upper(slug), ': DIMENSIÓN') AS criterio, '' AS nivel_humano FROM s, (SELECT unnest({list(V.SLUGS)}) AS slug)")
def _(spark, d):
    return quality.gold_template(select.sample(V.corpus(spark, d), 50, 45), rubric.criteria(spark, V.rubric()))


# ---------------------------------------------------------------------------------------- export


@query("export_tidy", f"WITH {V.RES_SQL} SELECT tweet_id, (list_position({list(V.SLUGS)}, slug))::VARCHAR AS id_criterio, slug, concat('CRITERIO ', upper(slug), ': DIMENSIÓN') AS criterio, aplicable, nivel, puntaje, justificacion, estado, detalle, contexto_incompleto FROM res WHERE tweet_id IN (SELECT doc_id::VARCHAR FROM documents)")
def _(spark, d):
    return export.tidy(_resolved(spark, d), V.corpus(spark, d), rubric.criteria(spark, V.rubric()))


_WIDE = ", ".join(f"max(nivel) FILTER (slug = '{s}') AS {s}_nivel, max(justificacion) FILTER (slug = '{s}') AS {s}_justificacion, max(CASE estado WHEN 'OK' THEN 'SI' WHEN 'NO_APLICABLE' THEN 'NO' ELSE estado END) FILTER (slug = '{s}') AS {s}_aplicable, max(puntaje) FILTER (slug = '{s}') AS {s}_puntaje" for s in V.SLUGS)


@query("export_wide", f"WITH {V.RES_SQL}, {V.CORPUS_SQL}, w AS (SELECT tweet_id, {_WIDE} FROM res GROUP BY tweet_id) SELECT corpus.*, w.* EXCLUDE (tweet_id) FROM corpus LEFT JOIN w ON id = tweet_id")
def _(spark, d):
    return export.wide(_resolved(spark, d), V.corpus(spark, d), V.SLUGS, V.SLUGS)


@query("export_orphans", f"WITH {V.RES_SQL} SELECT DISTINCT tweet_id FROM res WHERE tweet_id NOT IN (SELECT doc_id::VARCHAR FROM documents)")
def _(spark, d):
    return temporal.orphans(_resolved(spark, d), V.corpus(spark, d))


# -------------------------------------------------------------------------------------- temporal


@query("viz_cube", f"WITH {V.CUBE_SQL} SELECT * FROM cube")
def _(spark, d):
    return _cube(spark, d)


@query("viz_prepare_report", f"""WITH {V.READY_SQL}, o AS (SELECT count(*) AS orphans, count(DISTINCT tweet_id) AS orphan_tweets FROM res WHERE tweet_id NOT IN (SELECT id FROM corpus)),
g AS (SELECT count(*) AS ratings, count(DISTINCT tweet_id) AS tweets, count(DISTINCT dia) AS days, min(fecha) AS first_day, max(fecha) AS last_day, round(count(*) FILTER (NOT autosuficiente) / greatest(count(*), 1), 6) AS incomplete, count(*) FILTER (periodo IS NULL) AS outside FROM ready)
SELECT g.*, round(tweets / greatest(days, 1), 1) AS per_day, tweets / greatest(days, 1) < 30 AS low_coverage, orphans, orphan_tweets, orphan_tweets > 0 AND orphan_tweets = (SELECT count(DISTINCT tweet_id) FROM res) AS no_match, 0::BIGINT AS unreadable FROM g, o""")  # fmt: skip
def _(spark, d):
    return temporal.prepare_report(_ready(spark, d), _resolved(spark, d), V.corpus(spark, d))


_FORMATS = {"iso": "yyyy-MM-dd'T'HH:mm:ss", "plain": "yyyy-MM-dd H:mm:ss", "api": "E MMM dd HH:mm:ss +0000 yyyy", "us": "M/d/yyyy H:mm"}


@query("time_mixed_layouts", "SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL WHEN 3 THEN epoch(date_trunc('minute', ts))::BIGINT ELSE epoch(date_trunc('second', ts))::BIGINT END AS seconds FROM events")
def _(spark, d):
    ts = F.col("ts").cast("timestamp")
    text = F.lit("sin fecha")
    for k, f in enumerate(_FORMATS.values()):
        text = F.when(F.col("event_id") % 5 == k, F.date_format(ts, f.replace("+0000", "'+0000'"))).otherwise(text)
    return V.read(spark, d, "events").select("event_id", F.unix_timestamp(time.utc(text)).alias("seconds"))


@query("viz_volume", f"WITH {V.READY_SQL} SELECT fecha, idioma, autosuficiente, count(DISTINCT tweet_id) AS n FROM ready GROUP BY ALL")
def _(spark, d):
    return temporal.volume(_ready(spark, d))


@query("viz_languages", f"WITH {V.READY_SQL} SELECT idioma, count(DISTINCT tweet_id) AS tweets FROM ready GROUP BY idioma")
def _(spark, d):
    return temporal.languages(_ready(spark, d))


_PERIODS = (*V.PERIODS[:2], Period("vacío", date(2030, 1, 1), date(2030, 2, 1)), Period("abierto", date(2031, 1, 1)))


@query("viz_periods", f"""WITH {V.READY_SQL}, p AS (SELECT CASE WHEN periodo <> 'despues' THEN periodo END AS periodo, fecha, tweet_id FROM ready), g AS (SELECT periodo, count(DISTINCT fecha) AS days, count(DISTINCT tweet_id) AS tweets FROM p GROUP BY periodo)
SELECT n.periodo, coalesce(days, 0) AS days, coalesce(tweets, 0) AS tweets, round(coalesce(tweets, 0) / greatest(coalesce(days, 0), 1), 1) AS per_day FROM (SELECT unnest(['antes', 'durante', 'vacío', 'abierto']) AS periodo) n LEFT JOIN g USING (periodo)""")  # fmt: skip
def _(spark, d):
    ready = temporal.prepare(_resolved(spark, d), V.corpus(spark, d), "ts", V.ZONE, _PERIODS, ts_in_corpus=False)
    return temporal.by_period(ready, _PERIODS)


@query("viz_class_totals", f"WITH {V.CUBE_SQL}, g AS (SELECT slug, coalesce(sum(n) FILTER (clase = 'valencia'), 0)::BIGINT AS valencia, coalesce(sum(n) FILTER (clase = 'ausencia'), 0)::BIGINT AS ausencia, coalesce(sum(n) FILTER (clase = 'fallida'), 0)::BIGINT AS fallida, sum(n)::BIGINT AS total FROM cube GROUP BY slug) SELECT *, round(valencia / total, 6) AS share_valencia, round(ausencia / total, 6) AS share_ausencia, round(fallida / total, 6) AS share_fallida FROM g")
def _(spark, d):
    return temporal.class_totals(_cube(spark, d))


@query("viz_dates", f"WITH {V.READY_SQL} SELECT DISTINCT fecha FROM ready")
def _(spark, d):
    return temporal.dates(_cube(spark, d))


@query("viz_daily", f"WITH {V.CUBE_SQL} SELECT * FROM daily")
def _(spark, d):
    return temporal.daily(_cube(spark, d), _LEVELS)


@query("viz_daily_filtered", f"WITH {V.CUBE_SQL} SELECT fecha, slug, coalesce(sum(n) FILTER (clase = 'valencia'), 0)::BIGINT AS con_valencia, coalesce(sum(n) FILTER (clase = 'ausencia'), 0)::BIGINT AS ausencia, coalesce(sum(n) FILTER (clase = 'fallida'), 0)::BIGINT AS fallida FROM cube WHERE idioma IN ('en', 'fr') AND autosuficiente GROUP BY fecha, slug")
def _(spark, d):
    return temporal.daily(temporal.chosen(_cube(spark, d), ["en", "fr"], True), _LEVELS)


@query("viz_salience", f"WITH {V.CUBE_SQL} SELECT * FROM sal")
def _(spark, d):
    return temporal.salience(temporal.daily(_cube(spark, d), _LEVELS))


@query("viz_salience_smoothed", f"WITH {V.CUBE_SQL}, grid AS (SELECT * FROM (SELECT DISTINCT fecha FROM sal), (SELECT DISTINCT slug FROM sal)) SELECT slug, fecha, salience, round(avg(salience) OVER (PARTITION BY slug ORDER BY fecha ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 6) AS smoothed FROM grid LEFT JOIN sal USING (fecha, slug)")
def _(spark, d):
    return temporal.smoothed(temporal.salience(temporal.daily(_cube(spark, d), _LEVELS)))


@query("viz_daily_share", f"""WITH {V.CUBE_SQL}, {V.LEVELS_SQL}, x AS (SELECT * FROM cube WHERE NOT (fecha LIKE '%7' AND slug = 'click')), days AS (SELECT DISTINCT fecha FROM x), g AS (SELECT fecha, slug, nivel, sum(n)::BIGINT AS n FROM x WHERE clase = 'valencia' GROUP BY ALL), seen AS (SELECT DISTINCT fecha, slug, TRUE AS here FROM x),
f AS (SELECT fecha, slug, nivel, CASE WHEN here THEN coalesce(n, 0) END::BIGINT AS n FROM (SELECT fecha, slug, nivel FROM days, levels) LEFT JOIN g USING (fecha, slug, nivel) LEFT JOIN seen USING (fecha, slug))
SELECT *, round(n / nullif(sum(n) OVER (PARTITION BY fecha, slug), 0), 6) AS share FROM f""")  # fmt: skip
def _(spark, d):
    return temporal.daily_levels(_cube(spark, d).where("NOT (fecha LIKE '%7' AND slug = 'click')"), _LEVELS)


@query("viz_dist_global", f"WITH {V.CUBE_SQL}, g AS (SELECT slug, nivel, sum(n)::BIGINT AS n FROM cube WHERE clase = 'valencia' GROUP BY ALL) SELECT *, round(n / sum(n) OVER (PARTITION BY slug), 6) AS share FROM g")
def _(spark, d):
    return temporal.level_distribution(_cube(spark, d))


@query("viz_dist_period", f"""WITH {V.CUBE_SQL}, {V.LEVELS_SQL}, p AS (SELECT *, CASE WHEN fecha >= '2024-01-21' THEN 'despues' WHEN fecha >= '2024-01-11' THEN 'durante' WHEN fecha >= '2024-01-01' THEN 'antes' END AS periodo FROM cube WHERE clase = 'valencia'),
g AS (SELECT periodo, slug, nivel, sum(n)::BIGINT AS n FROM p WHERE periodo IS NOT NULL GROUP BY ALL), f AS (SELECT periodo, slug, nivel, coalesce(n, 0)::BIGINT AS n FROM (SELECT * FROM (SELECT unnest(['antes', 'durante', 'despues']) AS periodo) CROSS JOIN levels) LEFT JOIN g USING (periodo, slug, nivel))
SELECT *, coalesce(round(n / nullif(sum(n) OVER (PARTITION BY periodo, slug), 0), 6), 0) AS share FROM f""")  # fmt: skip
def _(spark, d):
    return temporal.period_distribution(_cube(spark, d), V.PERIODS, _LEVELS)


@query("viz_volume_pivot", f"WITH {V.READY_SQL}, v AS (SELECT fecha, idioma, autosuficiente, count(DISTINCT tweet_id) AS n FROM ready GROUP BY ALL) SELECT fecha, coalesce(sum(n) FILTER (idioma = 'en'), 0)::BIGINT AS en, coalesce(sum(n) FILTER (idioma = 'fr'), 0)::BIGINT AS fr, coalesce(sum(n) FILTER (idioma = 'de'), 0)::BIGINT AS de, coalesce(sum(n) FILTER (idioma = 'es'), 0)::BIGINT AS es FROM v GROUP BY fecha")
def _(spark, d):
    return temporal.volume_by_language(temporal.volume(_ready(spark, d)), ["en", "fr", "de", "es"])


@query("viz_small_sample", f"WITH {V.READY_SQL}, v AS (SELECT fecha, idioma, autosuficiente, count(DISTINCT tweet_id) AS n FROM ready GROUP BY ALL) SELECT coalesce(sum(n), 0)::BIGINT AS tweets, coalesce(sum(n), 0) < 30 AS small FROM v WHERE idioma = 'es' AND autosuficiente")
def _(spark, d):
    return temporal.small_sample(temporal.chosen(temporal.volume(_ready(spark, d)), ["es"], True), 30)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
