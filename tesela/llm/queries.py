"""The queries op1 to op10 over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession

from . import bpe, exact_dedup, language_id, license_scan, mixing, near_dedup, quality_classifier, quality_rules, token_output, warc
from .common import table


def tokenizer(name: str) -> str:
    return importlib.import_module("public_tokenizers").path(name)


def split_pattern() -> str:
    return importlib.import_module("public_tokenizers").PATTERN


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_output(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc(table(spark, sf_dir, "pages"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"), split_pattern())


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), digest=True)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict:
    found = (op1_quality_rules, op2_license_scan, op3_near_dedup, op4_mix_sources, op5_token_output, op6_language_id, op7_warc, op8_bpe_round_trip, op9_exact_dedup, op10_quality_classifier)
    return {f.__name__: f for f in found}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP9 = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""

OP7 = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, url, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest, min(page_id) OVER (PARTITION BY html) AS first,
      row_number() OVER (PARTITION BY html ORDER BY page_id NULLS LAST, url NULLS LAST) AS place FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {warc.LEAST_REVISIT} AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {warc.LEAST_REVISIT} AND place > 1 THEN first END AS refers_to,
       coalesce(url, 'about:blank') AS target_uri
FROM d
"""


def _op1() -> str:
    q = quality_rules
    rates = [(m, f"({f} * {of} // n_words)") for m, of, f in q.RATES]
    metrics = " UNION ALL ".join(f"SELECT doc_id, lang, source, '{m}' AS metric, {r}::BIGINT AS v FROM good" for m, r in rates)
    least = " ".join(f"WHEN '{m}' THEN {v}" for m, v in q.LEAST_SPREAD.items())

    def level(name: str, by: str) -> str:
        keys = f"{by}, " if by else ""
        return f"""
{name}_c AS (SELECT {keys}metric, cell, sum(n) AS n FROM cells GROUP BY {keys}metric, cell),
{name}_e AS (SELECT *, sum(n) OVER (PARTITION BY {keys}metric ORDER BY cell) AS e, sum(n) OVER (PARTITION BY {keys}metric) AS docs FROM {name}_c),
{name} AS (SELECT {keys}metric, any_value(docs) AS docs, min(cell) FILTER (4 * e >= docs) AS q1, min(cell) FILTER (4 * e >= 2 * docs) AS q2, min(cell) FILTER (4 * e >= 3 * docs) AS q3 FROM {name}_e GROUP BY {keys}metric)"""

    pick = lambda c: f"CASE WHEN o.docs >= {q.LEAST_GROUP} THEN o.{c} WHEN t.docs >= {q.LEAST_GROUP} THEN t.{c} ELSE e.{c} END AS {c}"
    space = r"\x20\x09-\x0D"
    return f"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^{space}]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 4),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS n FROM i),
r AS (SELECT doc_id, count(DISTINCT k) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM g WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^{space}]')] AS l FROM w),
s AS (SELECT w.doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
      length(regexp_replace(text, '[^{q.SYMBOLS[1:-1]}]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
      coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM w JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
good AS (SELECT * FROM b WHERE NOT base_failed),
m AS ({metrics}),
cells AS (SELECT lang, source, metric, v - v % ({q.width_sql("v")}) AS cell, count(*) AS n FROM m GROUP BY ALL),
{level("o", "lang, source")},{level("t", "lang")},{level("e", "")},
q AS (SELECT o.lang, o.source, metric, {pick("q1")}, {pick("q2")}, {pick("q3")}, CASE metric {least} END AS least
      FROM o JOIN t USING (metric) JOIN e USING (metric) WHERE o.lang IS NOT DISTINCT FROM t.lang),
bound AS (SELECT lang, source, metric, CASE metric WHEN 'word_len' THEN q1 - {q.FACTOR} * greatest(q2 - q1, least) ELSE 0 END AS low,
          q3 + {q.FACTOR} * greatest(q3 - q2, least) AS high FROM q),
bad AS (SELECT DISTINCT doc_id FROM m JOIN bound USING (metric) WHERE m.lang IS NOT DISTINCT FROM bound.lang AND m.source IS NOT DISTINCT FROM bound.source AND NOT v BETWEEN low AND high)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.doc_id IS NULL AS kept
FROM b LEFT JOIN bad USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": _op1(), "op7_warc": OP7, "op9_exact_dedup": OP9}
