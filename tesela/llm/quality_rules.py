"""Quality rules whose thresholds adapt to each language and source.

One scan takes the statistics of every whole text. Their integer rates go into quantile sketches: counts
of cells whose width is a fixed fraction of the value (a relative-error histogram after DDSketch, with
power-of-two widths). Sketches of (language, source) merge by adding counts into those of a language and of
everything, which stand in where a group has too few documents. A fence above the upper quartile (and below the
lower one for word length), as wide as the spread of the group's own values, replaces fixed cutoffs. Cells
are whole numbers, so thresholds do not depend on the order in which rows or retried tasks arrive.

Only DataFrame functions are used. Defined cases: a null text has no words and fails the base rules; a null
language or source is a group like any other; repeated rows are judged alike; an empty table gives an
empty result; further columns of the input are ignored (or returned by `keep_good`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept_at, words

SYMBOLS = "[#*$%&|<>]"
#: Rates on which verdicts rest: name, numerator, factor; all are divided by n_words.
RATES = (("word_len", "word_chars", 100), ("symbols", "n_symbols", 1000), ("dup_lines", "n_dup_lines", 1000), ("repeats", "n_repeat_words", 1000))
#: The least spread that a fence is built with, so that a group of nearly equal documents keeps them all.
LEAST_SPREAD = {"word_len": 60, "symbols": 15, "dup_lines": 15, "repeats": 120}
FACTOR = 3
#: Documents that a group's own sketch needs; else its language's is used, then the sketch of all.
LEAST_GROUP = 100
SUB_BITS = 7


def _repeat_words(w: Column) -> Column:
    """Words covered by three-word windows that occur twice or more in the array w."""
    grams = F.transform(F.sequence(F.lit(0), F.size("__w") - 3), lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)))
    return F.when(F.size(w) >= 4, grams)


def _starts(grams: Column) -> Column:
    """Where the windows that occur more than once begin, from sorted (hash, position) pairs."""
    pairs = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    return pairs


def _same(pairs: str, i: Column, x: Column) -> Column:
    near = lambda d: F.coalesce(F.get(pairs, i + d)["g"] == x["g"], F.lit(False))
    return near(-1) | near(1)


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with __n_words, __word_chars, __n_symbols, __n_dup_lines, __n_repeat_words (long)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("__w", words(text))
    out = out.withColumn("__g", _repeat_words(F.col("__w")))
    out = out.withColumn("__s", F.sort_array("__g"))
    again = F.exists(F.sequence(F.lit(1), F.size("__s") - 1), lambda i: F.get("__s", i) == F.get("__s", i - 1))
    out = out.withColumn("__p", F.when(again, _starts(F.col("__g"))))
    starts = F.transform(F.filter("__p", lambda x, i: _same("__p", i, x)), lambda x: x["i"])
    covered = F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^ \t-\r]"))
    out = out.withColumn("__l", lines)
    cols = {
        "__n_words": F.size("__w"),
        "__word_chars": F.length(F.concat_ws("", "__w")),
        "__n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "__n_dup_lines": F.size("__l") - F.size(F.array_distinct("__l")),
        "__n_repeat_words": F.when(F.col("__p").isNull(), 0).otherwise(covered),
    }
    return out.withColumns({k: v.cast("long") for k, v in cols.items()}).drop("__w", "__g", "__s", "__p", "__l")


def base_failed() -> Column:
    return (F.col("__n_words") < 50) | (100 * F.col("__n_repeat_words") > 50 * F.col("__n_words"))


def rate(of: str, factor: int) -> Column:
    return F.expr(f"(({factor} * __{of}) div __n_words)")


def width_sql(v: str, bits: int = SUB_BITS) -> str:
    """The width of the cell of a whole number v, in SQL: a power of two, 1 / 2**bits of v at most."""
    steps = " ".join(f"WHEN {v} < {1 << (bits + 1 + k)} THEN {1 << k}" for k in range(40))
    return f"CASE {steps} ELSE {1 << 40} END"


def sketches(stats: DataFrame) -> DataFrame:
    """lang, source, metric, cell, n: the sketch of each group."""
    m = F.array(*[F.struct(F.lit(k).alias("metric"), rate(of, f).alias("v")) for k, of, f in RATES])
    long = stats.where(~base_failed()).select("lang", "source", F.explode(m).alias("m")).select("lang", "source", "m.metric", "m.v")
    return long.groupBy("lang", "source", "metric", F.expr(f"v - v % ({width_sql('v')})").alias("cell")).agg(F.count("*").alias("n"))


def quantiles(cells: DataFrame, by: list[str]) -> DataFrame:
    """by, metric, docs, q1, q2, q3: the quartiles of merged sketches, as the least cell that reaches them."""
    merged = cells.groupBy(*by, "metric", "cell").agg(F.sum("n").alias("n"))
    each = merged.groupBy(*by, "metric").agg(F.sum("n").alias("docs"), F.array_sort(F.collect_list(F.struct("cell", "n"))).alias("c"))
    ends = F.aggregate("c", F.struct(F.array().cast("array<bigint>").alias("s"), F.lit(0).cast("bigint").alias("t")), lambda a, x: F.struct(F.concat(a["s"], F.array(a["t"] + x["n"])).alias("s"), (a["t"] + x["n"]).alias("t")), lambda a: a["s"])
    each = each.withColumn("e", ends)
    at = lambda q: F.get(F.transform(F.filter(F.arrays_zip("c", "e"), lambda z: 4 * z["e"] >= q * F.col("docs")), lambda z: z["c"]["cell"]), F.lit(0))
    return each.select(*by, "metric", "docs", at(1).alias("q1"), at(2).alias("q2"), at(3).alias("q3"))


def thresholds(stats: DataFrame) -> DataFrame:
    """One row per (lang, source): bounds, a map from metric to (low, high)."""
    cells = kept_at(sketches(stats), "op1-cells")[0]
    own, tongue, every = quantiles(cells, ["lang", "source"]), quantiles(cells, ["lang"]), quantiles(cells, [])
    q = lambda df, p, key: df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns], *key)
    o, t, e = q(own, "o", []), q(tongue, "t", []), q(every, "e", [])
    joined = o.join(t, F.col("o_lang").eqNullSafe(F.col("t_lang")) & (F.col("o_metric") == F.col("t_metric"))).join(F.broadcast(e), F.col("o_metric") == F.col("e_metric"))
    pick = lambda c: F.when(F.col("o_docs") >= LEAST_GROUP, F.col(f"o_{c}")).when(F.col("t_docs") >= LEAST_GROUP, F.col(f"t_{c}")).otherwise(F.col(f"e_{c}"))
    least = F.create_map(*[x for k, v in LEAST_SPREAD.items() for x in (F.lit(k), F.lit(v).cast("long"))])
    b = joined.select(F.col("o_lang").alias("lang"), F.col("o_source").alias("source"), F.col("o_metric").alias("metric"), pick("q1").alias("q1"), pick("q2").alias("q2"), pick("q3").alias("q3"), least[F.col("o_metric")].alias("least"))
    low = F.when(F.col("metric") == "word_len", F.col("q1") - FACTOR * F.greatest(F.col("q2") - F.col("q1"), "least")).otherwise(F.lit(0).cast("long"))
    high = F.col("q3") + FACTOR * F.greatest(F.col("q3") - F.col("q2"), "least")
    one = lambda m, c: F.max(F.when(F.col("metric") == m, c)).alias(f"{m}_{'low' if c is low else 'high'}")
    return b.groupBy("lang", "source").agg(*[x for m, _, _ in RATES for x in (one(m, low), one(m, high))])


def judged(stats: DataFrame, bounds: DataFrame) -> DataFrame:
    """stats with __base_failed and __kept."""
    b = bounds.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), *[F.col(f"{m}_{e}").alias(f"__{m}_{e}") for m, _, _ in RATES for e in ("low", "high")])
    joined = stats.join(b, stats["lang"].eqNullSafe(b["__lang"]) & stats["source"].eqNullSafe(b["__source"]), "left")
    inside = F.lit(True)
    for m, of, f in RATES:
        inside = inside & rate(of, f).between(F.col(f"__{m}_low"), F.col(f"__{m}_high"))
    joined = joined.withColumn("__base_failed", base_failed())
    return joined.withColumn("__kept", F.when(F.col("__base_failed"), False).otherwise(F.coalesce(inside, F.lit(True))))


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept for every
    row of docs (doc_id, text, lang, source)."""
    stats = kept_at(with_stats(docs.select("doc_id", "text", "lang", "source")).drop("text"), "op1-stats")[0]
    out = judged(stats, thresholds(stats))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return out.select("doc_id", *[F.col(f"__{c}").alias(c) for c in names])


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with the columns of docs. Texts and statistics are written once,
    so the texts are measured once and never shuffled."""
    stats = kept_at(with_stats(docs), "op1-docs")[0]
    bounds = kept_at(thresholds(stats), "op1-bounds")[0]  # of a known size, so that it is broadcast if it is small
    return judged(stats, bounds).where("__kept").select(*docs.columns)
