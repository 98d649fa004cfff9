"""Pieces and words that share a hash, added tokens, windows, recall, and results computed a second way."""

import hashlib
import math
import random
from collections import Counter
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tesela.llm import bpe, language_id, license_scan, mixing, near_dedup, quality_classifier, shingles, token_output, warc
from tesela.llm.common import drawn, shared_dir, stored
from tesela.llm.components import components
from tesela.llm.queries import split_pattern, tokenizer

SF = "/root/testdata/sf0.001"
SPECIAL = "<|endoftext|>"
ALPHABET = [*" \n\t\x0b\x1c\x85\xa0　.,'s_ab1é日½<|>", SPECIAL]


def thue_morse(n, flip):
    return "".join(chr(97 + ((k.bit_count() + flip) & 1)) for k in range(n))


PAIRS = [thue_morse(n, flip) for n in (1024, 2048) for flip in (0, 1)]


def joined(texts):
    coded = [t.encode() for t in texts]
    return np.frombuffer(b"".join(coded), np.uint8), np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64)


def rank_codec():
    return bpe.Codec(bpe.read_file(tokenizer("byte_bpe_50k.tiktoken")), split_pattern())


def by_tiktoken():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=split_pattern(), mergeable_ranks=bpe.read_ranks(bpe.read_file(tokenizer("byte_bpe_50k.tiktoken"))), special_tokens={}).encode_ordinary


def by_library():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    return lambda t: tok.encode(t, add_special_tokens=False).ids


@pytest.fixture(params=["ranks", "library"])
def coder(request):
    if request.param == "ranks":
        return rank_codec(), by_tiktoken()
    return bpe.Codec(bpe.read_file(tokenizer("byte_bpe_50k.json")), None), by_library()


def test_pieces_that_share_a_hash_keep_their_ids(coder):
    codec, whole = coder
    raw, at = joined(PAIRS[:2])
    assert len(set(shingles.fast_hashes(raw, at[:-1], at[1:]).tolist())) == 1  # they do share one
    texts = [*PAIRS, *(f"x {p}" for p in PAIRS), PAIRS[1] + " " + PAIRS[0]]
    for _ in range(2):  # anew, and from the table
        assert [np.frombuffer(x, np.uint32).tolist() for x in codec.encode(texts)] == [whole(t) for t in texts]


def test_added_tokens_are_those_of_the_library(coder):
    codec, whole = coder
    texts = [f"foo {SPECIAL} bar", SPECIAL, SPECIAL * 2, f"a{SPECIAL}", f"{SPECIAL}b", f"a  {SPECIAL}  b", f"x\n{SPECIAL}\n y", f"a.{SPECIAL},b", f"1,{SPECIAL}.2", f" {SPECIAL}", f"{SPECIAL} ", "<|endoftext"]
    rng = random.Random(5)
    texts += ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    assert [np.frombuffer(x, np.uint32).tolist() for x in codec.encode(texts)] == [whole(t) for t in texts]


def test_windows_change_nothing(monkeypatch):
    rng, codec, whole = random.Random(6), rank_codec(), by_tiktoken()
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 400))) for _ in range(40)]
    raw, rows = joined(texts)
    wide = [shingles.shingle_sets(raw, rows), language_id.counts(raw, rows)]
    for module in (shingles, bpe, language_id):
        monkeypatch.setattr(module, "WINDOW", 64)
    ids, at = codec.encode_bytes(raw, rows)
    assert [ids[a:z].tolist() for a, z in zip(at[:-1], at[1:], strict=True)] == [whole(t) for t in texts]
    back, places = codec.decode_bytes(ids, at)
    assert np.array_equal(back, raw) and np.array_equal(places, rows)
    assert all(np.array_equal(a, b) for a, b in zip(wide[0], shingles.shingle_sets(raw, rows), strict=True))
    assert np.array_equal(wide[1], language_id.counts(raw, rows))


def test_documents_that_share_a_hash_are_kept_apart(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(PAIRS, 1)], "doc_id long, text string")
    assert {r["component_id"] for r in near_dedup.near_dedup(df).collect()} == {1, 2, 3, 4}
    got = bpe.round_trip(df, tokenizer("byte_bpe_50k.tiktoken"), split_pattern()).collect()
    assert {r["doc_id"]: r["decoded_sha256"] for r in got} == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in enumerate(PAIRS, 1)}
    assert corpus_pipeline.tokens(spark, df.selectExpr("*", "'l' AS lang", "'s' AS source"), SF).where("round_trip").count() == 4


# ------------------------------------------------------------------------------- near-dedup


def jaccard_pair(rng, n, share):
    """Two sorted arrays of hashes with at least `share` in common, as close to it as n allows."""
    m = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
    own = int((1 - share) * n + 1e-9)  # of n in both, these are in one of the two
    a, b = m[own // 2 :], np.concatenate([m[: own // 2], m[own:]])
    return np.sort(a), np.sort(b)


def test_likely_loses_no_pair_at_the_threshold():
    rng = np.random.default_rng(2)
    for n in (7, 14, 40, 100, 300, 2000):
        for _ in range(300):
            pair = jaccard_pair(rng, n, 0.85)
            assert 100 * len(np.intersect1d(*pair)) >= 85 * len(np.union1d(*pair))
            lows = np.stack([near_dedup.signature(x).astype(np.uint8) for x in pair])
            sizes = np.array([len(x) for x in pair])
            least = [near_dedup.unpacked(near_dedup.packed(x)) for x in pair]
            assert len(near_dedup.likely(lows, sizes, 85)[0]) == len(near_dedup.likely_by_least(least, sizes, 85)[0]) == 1


def test_recall_of_pairs_at_085_to_090(spark):
    rng = random.Random(3)
    rows = []
    for k in range(150):
        words = [f"w{rng.randrange(10**6)}" for _ in range(204)]
        changed = list(words)
        # a changed word far from the others takes 5 of 200 shingles: 3 and 2 of them leave 185 / 215 = 0.86 and 190 / 210 = 0.905
        for j in rng.sample(range(10, 190, 12), 3 if k % 2 else 2):
            changed[j] = f"v{rng.randrange(10**6)}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(changed))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for leaf, depth in ((256, 8), (2, 2)):
        got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(df, leaf=leaf, depth=depth).collect()}
        assert got == {i: i - i % 2 for i, _ in rows}


def test_rows_that_share_an_id_are_judged_by_their_text(spark):
    text = [" ".join(f"{c}{j}" for j in range(60)) for c in "ab"]
    df = spark.createDataFrame([(1, text[0]), (2, text[0] + " x"), (2, text[1]), (2, text[1])], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"]) for r in near_dedup.keep_one(df).collect()) == sorted([(1, text[0]), (2, text[1]), (2, text[1])])


def test_blocks_let_all_sets_of_different_components_meet(spark):
    rng = random.Random(5)
    rows = [(1, rep, rep if rep % 3 else 0) for rep in range(60)] + [(2, rep, rep) for rep in range(100, 103)] + [(3, 200, 200), (3, 201, 201), (3, 202, 200)]
    rng.shuffle(rows)
    met = {}
    for r in near_dedup._blocks(spark.createDataFrame(rows, "node long, rep long, comp long"), 8).collect():
        met.setdefault(r["node"], set()).add(r["rep"])
    for n1, a, c in rows:
        for n2, b, d in rows:
            if n1 == n2 and c != d:
                assert any({a, b} <= reps for reps in met.values())


def test_hub_pairs_meet_their_sets(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "HUB", 3)
    pairs = spark.createDataFrame([(0, k) for k in range(1, 20)] + [(k, 30) for k in range(1, 12)], "a long, b long")
    sets = spark.range(31).select(F.col("id").alias("rep"), F.col("id").cast("string").cast("binary").alias("shingles"))
    got = near_dedup._with_sets(near_dedup._with_sets(pairs, sets, "a", "b", "sa"), sets, "b", "a", "sb").collect()
    assert Counter((r["a"], r["b"], bytes(r["sa"]), bytes(r["sb"])) for r in got) == Counter((r["a"], r["b"], str(r["a"]).encode(), str(r["b"]).encode()) for r in pairs.collect())


def test_trees_that_meet_one_large_group_hold_it_once(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 32, near_dedup.COORDS, dtype=np.uint32)
    rows = []
    for rep in range(300):
        sig = np.where(rng.random(near_dedup.COORDS) < 0.04, rng.integers(0, 1 << 32, near_dedup.COORDS, dtype=np.uint32), base)
        rows.append((rep, sig.tobytes()))
    _, over = near_dedup._leaves(spark.createDataFrame(rows, "rep long, sig binary"), 16, 32, 4, 85)
    assert over.count() <= 900 and over.select("rep").distinct().count() == 300  # 16 trees, each with nearly all of the 300
    assert over.distinct().count() == over.count()


def test_sets_of_a_large_node_meet_on_lines(spark):
    rows = [(1, rep, rep) for rep in range(700)] + [(2, rep, rep) for rep in range(1000, 1020)]
    met = {}
    for r in near_dedup._blocks(spark.createDataFrame(rows, "node long, rep long, comp long"), 64).collect():
        met.setdefault(r["node"], set()).add(r["rep"])
    assert sum(map(len, met.values())) <= 13 * 700 + 20 and max(map(len, met.values())) <= 110  # blocks of 32 held 21 * 700
    pairs = {(a, b) for reps in met.values() for a in reps for b in reps if a < b}
    assert len(pairs) == 700 * 699 // 2 + 20 * 19 // 2


def test_small_tables_take_few_of_many_partitions(spark):
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    rows = [(k, " ".join(f"w{k // 2}-{j}" for j in range(60)) + f" own{k}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    chain = spark.createDataFrame([(k + 1, k) for k in range(300)], "u long, v long").coalesce(1)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        sc.setJobGroup("few-tasks", "tasks of small tables")
        assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(docs).collect()} == {k: k // 2 * 2 for k, _ in rows}
        found = components(chain)
        assert {r["root"] for r in found.collect()} == {0} and len(found.inputFiles()) <= 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        sc.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for job in tracker.getJobIdsForGroup("few-tasks") for s in tracker.getJobInfo(job).stageIds}
    tasks = [info.numTasks for info in map(tracker.getStageInfo, stages) if info and info.numCompletedTasks]
    assert len(tasks) > 50 and sum(tasks) <= 6 * len(tasks)  # one shuffle of narrow rows after another took 64 tasks each


def test_order_of_a_plane_is_the_next_prime(spark):
    got = {r["n"]: r["q"] for r in spark.range(1, 3000).select(F.col("id").alias("n"), near_dedup._order(F.col("id"), 8).alias("q")).collect()}
    primes = [q for q in range(2, 800) if all(q % d for d in range(2, int(q**0.5) + 1))]
    assert got == {n: 1 if n <= 8 else next(q for q in primes if 8 * q >= n) for n in got}


def test_full_sets_move_once_a_cell_and_every_pair_is_in_one(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CELL_SHINGLES", 50_000)
    pairs = [(a, b) for a in range(200) for b in range(a + 1, 200)] + [(300, 301), (400, 401)]
    sizes = [(rep, 100) for rep in range(200)] + [(300, 100), (301, 100), (400, 10**6), (401, 10**6)]
    rows = near_dedup._cells(spark.createDataFrame(pairs, "a long, b long"), spark.createDataFrame(sizes, "rep long, n_shingles long")).collect()
    cells = {}
    for r in rows:
        assert r["rep"] not in cells.setdefault(r["cell"], set())
        cells[r["cell"]].add(r["rep"])
    assert sorted((r["rep"], b) for r in rows for b in r["others"]) == pairs
    assert all(set(r["others"]) <= cells[r["cell"]] for r in rows)
    assert len(rows) <= 200 * 4 + 4  # not a set for each of 19900 pairs


def test_repeated_sets_are_single(spark):
    sets = spark.createDataFrame([(1, b"a"), (2, b"b"), (1, b"a"), (3, b"c")], "rep long, shingles binary")
    assert sorted((r["rep"], bytes(r["shingles"])) for r in near_dedup._single(sets).collect()) == [(1, b"a"), (2, b"b"), (3, b"c")]


# ------------------------------------------------------------------------------------ samples


def test_drawn_documents_are_bounded_and_never_none(spark):
    many = spark.range(30_000).selectExpr("0L AS doc_id", "'a' AS k").unionByName(spark.range(500).selectExpr("id AS doc_id", "'b' AS k"))
    got, sizes = drawn(many, "k", 50, 1)
    assert Counter(r["k"] for r in got.collect()) == {"a": 1, "b": 50} and sizes == {"a": 30_000, "b": 500}
    assert drawn(many.limit(0), "k", 50, 1)[0].count() == 0


def test_fits_on_repeated_rows(spark):
    text = "una frase con palabras"
    docs = spark.range(20_000).selectExpr("1L AS doc_id", f"'{text}' AS text", "'es' AS lang")
    labels = spark.range(20_000).selectExpr("1L AS doc_id", "1 AS quality", "0 AS toxic")
    assert language_id.fit(docs)["langs"] == ["es"]
    assert quality_classifier.fit(docs, labels) is not None
    assert mixing.fit(docs, labels).shape == (3, mixing.FEATURES + 1)


# --------------------------------------------------------------------- results a second way


def grams(text):
    b = [x + 32 if 65 <= x <= 90 else 32 if x < 128 and not chr(x).isalpha() else x for x in text.encode()]
    out = Counter()
    for size in (2, 3):
        for k in range(len(b) - size + 1):
            g = b[k : k + size]
            if (g[0], g[1]) != (32, 32) and (g[-2], g[-1]) != (32, 32):
                code = sum(x << 8 * (size - 1 - j) for j, x in enumerate(g)) + (1 << 24 if size == 3 else 0)
                out[((code & 0xFFFFFFFF) * 2654435761 & 0xFFFFFFFF) >> 20] += 1
    return out


def test_language_scores_a_second_way(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs)
    got = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    centres = [(lang, c.astype(float)) for lang, c in zip(model["langs"], model["centres"], strict=True)]
    for row in docs.select("doc_id", "text").limit(25).collect():
        v = {d: math.log1p(n) * float(model["idf"][d]) for d, n in grams(row["text"] or "").items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1
        best = max(((sum(x * c[d] for d, x in v.items()) / norm, lang) for lang, c in centres))
        r = got[row["doc_id"]]
        if r["lang_pred"] != "und":
            assert r["score"] == pytest.approx(min(1, max(0, best[0])), abs=1e-4) and r["lang_pred"] == best[1]


def test_quality_scores_a_second_way(spark):
    rng, net = np.random.default_rng(4), quality_classifier.Net(3)
    texts = ["", "a", "é" * 300, *("".join(rng.choice(list("abc defg\n"), n)) for n in (15, 16, 511, 512, 513, 1500))]
    p = {k: v.astype(float) for k, v in net.p.items()}

    def by_loops(text):
        raw = text.encode()
        total = np.zeros(quality_classifier.FILTERS)
        begins = range(0, max(1, len(raw)), 512)
        for at in begins:
            chunk = (raw[at : at + 526] + bytes(526))[:526]
            best = np.zeros(quality_classifier.FILTERS)
            for k in range(0, 511, 2):
                window = np.concatenate([p["e"][b] for b in chunk[k : k + 16]])
                best = np.maximum(best, window @ p["w"] + p["c"])
            total += best
        return 1 / (1 + math.exp(-(total / len(begins) @ p["v"] + p["d"][0])))

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in quality_classifier.predict(df, net).collect()}
    assert [got[k] for k in range(len(texts))] == pytest.approx([by_loops(t) for t in texts], abs=1e-4)


def test_long_labelled_texts_are_learned_from():
    raw, at = joined(["x" * 200_000 + "needle" + "x" * 200_000, "short"])
    first = quality_classifier.chunk_counts(at)
    long, short = quality_classifier.spread(first)
    assert len(long) == quality_classifier.LEARNED and long[0] == 0 and long[-1] == first[1] - 1 and short.tolist() == [first[1]]


def test_every_template_is_found_in_a_text():
    rng = random.Random(8)
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    filler = [f"palabra{k}" for k in range(50)]
    for name, listed in license_scan.TEMPLATES.items():
        for template in listed:
            around = [" ".join(rng.choices(filler, k=rng.randint(0, 400))) for _ in range(2)]
            text = f"{around[0]}\n{template}\n{around[1]}"
            found = [(r[2], text[r[0] : r[1]]) for r in scanner.scan(text) if r[5]]
            assert [n for n, _ in found] == [name], template
            assert found[0][1].strip(".)") == template.strip(".)"), template


def test_mixture_reaches_the_weights_in_written_tokens(spark):
    words = {"clean": "casa río monte libro", "low": "zz qq xx ww", "toxic": "feo malo horrible odio"}
    rng, rows, labels = random.Random(9), [], []
    for k in range(1200):
        kind = "clean" if k < 1000 else "low" if k < 1150 else "toxic"
        rows.append((k, " ".join(rng.choices(words[kind].split(), k=40)), "s"))
        labels.append((k, int(kind != "low"), int(kind == "toxic")))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mixed(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).select("doc_id").collect()
    kinds = Counter("clean" if r["doc_id"] < 1000 else "low" if r["doc_id"] < 1150 else "toxic" for r in out)
    for name, weight in mixing.WEIGHTS.items():
        assert kinds[name] / len(out) == pytest.approx(weight, abs=0.015)


# --------------------------------------------------------------------------- files and archives


def test_token_pages_are_skipped_and_equal_ids_are_dealt_over_files(spark, tmp_path):
    path = tokenizer("byte_bpe_50k.json")
    docs = spark.range(0, 12_000, 1, 1).selectExpr("IF(id < 6000, NULL, IF(id < 9000, 7, id)) AS doc_id", "concat('texto número ', id) AS text")
    out = f"file://{tmp_path}/t"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    token_output.write_tokens(docs, out, path, page_rows=200)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(out).groupBy(F.col("_metadata.file_name")).agg(F.count("*").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).collect()
    assert len([r for r in files if r["nulls"]]) > 1 and max(r["n"] for r in files) < 6000
    some = token_output.read_tokens(spark, out, 11_000, 11_010)
    assert some.count() == 11
    read = some._jdf.queryExecution()
    read.executedPlan().executeCollect()
    plan = read.executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    scan = plan.collectLeaves().head()
    assert 11 <= scan.metrics().apply("numOutputRows").value() <= 1000
    index = sorted((r["start"], r["n_tokens"]) for r in token_output.token_index(spark, out).collect())
    assert len(index) == 12_000 and all(a + n == b for (a, n), (b, _) in zip(index, index[1:], strict=False))


def test_warc_names_every_record_once_and_keeps_one_response(spark, tmp_path):
    big = "<p>" + "a" * 300
    rows = [(1, "http://b", big), (1, "http://a", big), (1, "http://a", big), (2, "http://c", big), (None, None, "x"), (None, None, "x"), (5, "http://d", "y" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = f"file://{tmp_path}/w"
    key = "mapreduce.output.fileoutputformat.compress"
    spark.conf.set(f"spark.hadoop.{key}", "true")
    spark._jsc.hadoopConfiguration().set(key, "true")
    try:
        warc.write_warc(warc.plan(pages), out, warc.train_dictionary(pages))
    finally:
        spark._jsc.hadoopConfiguration().set(key, "false")
        spark.conf.unset(f"spark.hadoop.{key}")
    got = warc.read_warc(spark, out).collect()
    assert len({r["record_id"] for r in got}) == len(rows) == len(got)
    assert Counter((r["page_id"], r["record_type"], r["refers_to"], r["target_uri"]) for r in got if r["payload_bytes"] == 303) == {
        (1, "response", None, "http://a"): 1, (1, "revisit", 1, "http://a"): 1, (1, "revisit", 1, "http://b"): 1, (2, "revisit", 1, "http://c"): 1,
    }


# ------------------------------------------------------------------------------- odd tables

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, ids string, score string, n_words string, __h string, license string, copies string"


def test_empty_tables_and_clashing_columns(spark):
    from tesela.llm import exact_dedup, quality_rules

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = [(k, t, "es", "s", 1, "c", "c", "c", "c", "c", "c", "c") for k, t in ((1, "All rights reserved."), (2, None), (3, ""), (1, "All rights reserved."), (None, "palabra " * 90))]
    for df in (spark.createDataFrame([], ODD_SCHEMA), spark.createDataFrame(rows, ODD_SCHEMA)):
        n = df.count()
        docs = {
            "rules": quality_rules.quality_rules(df), "near": near_dedup.near_dedup(df), "mix": mixing.mix(df.drop("__h"), labels), "language": language_id.language_id(df),
            "tokens": token_output.token_output(df, tokenizer("byte_bpe_50k.json")), "bpe": bpe.round_trip(df, tokenizer("byte_bpe_50k.tiktoken"), split_pattern()),
            "exact": exact_dedup.exact_dedup(df, digest=True), "quality": quality_classifier.quality_classifier(df, labels),
        }
        assert {k: v.count() for k, v in docs.items()} == dict.fromkeys(docs, n)
        assert license_scan.license_scan(df).where("confirmed").count() == (2 if n else 0)
        empty = quality_classifier.quality_classifier(df, labels.limit(0))
        assert empty.where("score = 0.5").count() == n


def test_pipeline_on_odd_rows(spark, tmp_path):
    base = [f"w{j * 7 % 211}" for j in range(200)]
    long = " ".join(base)
    near = " ".join([*base[:100], "otra", *base[101:]])
    rows = [(1, long), (2, long.upper()), (3, near), (None, " ".join(reversed(base))), (4, None), (5, ""), (6, "corto"), (3, near), (7, " ".join(f"z{j % 997}" for j in range(90_000)))]
    sf = str(tmp_path)
    for name, table in (("odd", rows), ("none", [])):
        path = f"{sf}/{name}"
        spark.createDataFrame([(i, t, "es", None, 0, "x") for i, t in table], "doc_id long, text string, lang string, source string, n_chars long, kept string").write.parquet(f"{path}/documents.parquet")
        spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{path}/labels.parquet")
        df = spark.read.parquet(f"{path}/documents.parquet")
        for stage_name, stage in corpus_pipeline.STAGES[:3]:
            df = stored(stage(spark, df, path), f"odd-{stage_name.split()[0]}")
            assert df.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"]
        if table:
            kept = sorted((r["doc_id"] or 0, r["text"]) for r in df.collect())
            assert [i for i, _ in kept] in ([0, 2, 7], [0, 2]) and all(t for _, t in kept)
        else:
            assert df.count() == 0
        out = corpus_pipeline.run(spark, path)
        assert out.where("NOT round_trip").count() == 0 and (out.count() > 0) == bool(table)


def test_a_stage_deletes_what_those_before_it_left_once_their_results_are_written(spark, tmp_path):
    folder = Path(urlparse(shared_dir(spark)).path) / "tesela"
    before = set(folder.glob("*"))
    copies = lambda: {p for p in folder.glob("op1-docs-*") if p not in before}
    rules, exact = [stage for _, stage in corpus_pipeline.STAGES[:2]]
    good = rules(spark, spark.read.parquet(f"{SF}/documents.parquet"), str(tmp_path))
    waiting = exact(spark, good, str(tmp_path))
    assert copies()  # both results are still to be read from the copy
    rows = waiting.count()
    good.write.parquet(f"{tmp_path}/good")
    left = set(folder.glob("*")) - before
    found = exact(spark, spark.read.parquet(f"{tmp_path}/good"), str(tmp_path))
    assert not copies() and not any(p.exists() for p in left) and found.count() == rows
