"""The corpus operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tesela.llm import bpe, components, exact_dedup, language_id, license_scan, mixing, near_dedup, quality_classifier, quality_rules, token_output, warc
from tesela.llm.common import stored
from tesela.llm.queries import split_pattern, tokenizer

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words string, len string"
LOREM = " ".join(f"palabra{k % 89} y{k % 53} cosa{k % 31}" for k in range(120))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "Hola"), (5, "hOLA"), (6, LOREM), (7, LOREM.upper()), (7, LOREM.upper()), (8, LOREM + " fin"), (None, "sin id"), (9, "x" * 300_000), (10, "日本語 é 🥹\x1c  z"), (11, LOREM + " fin de todo")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, None if i == 4 else "es", None if i == 6 else "s", 0, "c", "c", "c") for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words(t):
    return [w for w in re.split("[\x20\x09-\x0d]+", t or "") if w]


# ------------------------------------------------------------------------------------------ exact


def test_exact_dedup(odd):
    got = exact_dedup.exact_dedup(odd, digest=True).collect()
    assert len(got) == len(ODD)
    groups = {}
    for i, t in ODD:
        groups.setdefault(low(t), []).append(i)
    by = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by[r["text_sha256"]]
        assert r["group_size"] == len(ids) and r["keep_id"] == max(ids, key=lambda x: (x is not None, x))
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter(list(by))
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns and left.count() == len(groups)


def test_exact_dedup_prefix_twins_and_crowded_bitmap(spark):
    df = spark.createDataFrame([(1, "a" * 70 + "x"), (2, "a" * 70 + "y"), (3, "A" * 70 + "x")], "doc_id long, text string")
    for bits in (64, 1 << 12):
        assert {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_dedup(df, bitmap_bits=bits).collect()} == {1: 3, 2: 2, 3: 3}


# ------------------------------------------------------------------------------------------ rules


def brute_stats(t):
    w, t = words(t), t or ""
    grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    hit = {j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="ab #|é\n\t\x0b\x1c", max_size=80), min_size=1, max_size=20))
def test_rule_statistics(spark, texts):
    df = spark.createDataFrame([(k, t, "l", "s") for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for r in quality_rules.with_stats(df).collect():
        assert tuple(r[f"__{c}"] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute_stats(texts[r["doc_id"]])


def test_rules_on_odd_rows(odd):
    got = quality_rules.quality_rules(odd).collect()
    assert len(got) == len(ODD) and all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] < 50)
    assert quality_rules.keep_good(odd).columns == odd.columns


def test_rules_reject_what_stands_out(spark):
    clean = [(k, " ".join(f"w{(k * 7 + j * j) % 997}" for j in range(200)), "en", f"s{k % 2}") for k in range(300)]
    junk = [(1000 + k, " ".join(f"w{j}#$%" for j in range(200)), "en", f"s{k % 2}") for k in range(20)]
    df = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in quality_rules.quality_rules(df).where("kept").collect()}
    assert kept == set(range(300))


# ------------------------------------------------------------------------------------------- near


def shingles(t):
    w = words(low(t))
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def test_near_dedup_equals_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    roots, sizes = brute_components(rows)
    got = near_dedup.near_dedup(docs).collect()
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in got} == {i: (roots[i], sizes[i]) for i in roots}


def test_near_dedup_large_nodes_branch_and_meet_in_blocks(spark):
    rng = np.random.default_rng(1)
    rows = []
    for g in range(3):
        base = [f"g{g}w{j}" for j in range(120)]
        for k in range(40):
            w = list(base)
            for j in rng.integers(0, 120, k % 5):
                w[j] = f"v{g}-{k}-{j}"
            rows.append((g * 100 + k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    roots, _ = brute_components(rows)
    for depth in (1, 3):
        got = near_dedup.near_dedup(df, leaf=8, depth=depth).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == roots


def test_near_dedup_odd_rows(odd, spark):
    got = near_dedup.near_dedup(odd).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(ODD) and by[1]["n_shingles"] == 0 and by[1]["kept"] and by[None]["component_id"] is None
    assert by[5]["component_id"] == 4 and by[7]["component_id"] == 6 and by[8]["component_id"] == 6
    assert near_dedup.keep_one(odd).columns == odd.columns
    assert near_dedup.near_dedup(odd.limit(0)).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(100, 101), (101, 100), (7, 7)], "u long, v long")
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


# ------------------------------------------------------------------------------------------- bpe


@pytest.fixture(scope="module")
def reference_encoding():
    import tiktoken

    ranks = bpe.read_ranks(bpe.read_file(tokenizer("byte_bpe_50k.tiktoken")))
    return tiktoken.Encoding("own", pat_str=split_pattern(), mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_file(tokenizer("byte_bpe_50k.tiktoken")), split_pattern())


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(text=st.one_of(st.text(max_size=60), st.text(alphabet=" \n\t\r\x0b\x0c\x1c\x85\xa0 　.,'s_ab1é日½-", max_size=40)))
def test_ids_are_those_of_the_whole_text(codec, reference_encoding, text):
    ids = np.frombuffer(codec.encode([text])[0], np.uint32).tolist()
    assert ids == reference_encoding.encode_ordinary(text)
    assert codec.decode(ids) == text.encode() and "".join(codec.decode_pieces(ids)) == text
    raw, row = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())])
    start, end, split = codec.offsets(raw, row, np.array(ids, np.int64), np.array([0, len(ids)]))
    assert all(text[a:z].encode().find(codec.table[i]) >= 0 for a, z, i in zip(start, end, ids, strict=True))
    ends = np.cumsum([len(codec.table[i]) for i in ids])
    assert split.tolist() == [not text.encode()[:k].decode(errors="replace") == text[: len(text.encode()[:k].decode(errors="ignore"))] for k in ends]


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet=" \n\t\x0b\x1c\x85\xa0\u3000.,'s_ab1é日½<|>", max_size=40), min_size=1, max_size=60))
def test_new_pieces_encoded_together_keep_their_ids(reference_encoding, codec, texts):
    codec.pieces.clear()
    assert [np.frombuffer(x, np.uint32).tolist() for x in codec.encode(texts)] == [reference_encoding.encode_ordinary(t) for t in texts]


def test_pieces_whose_tokens_do_not_spell_them_are_encoded_alone(reference_encoding):
    codec = bpe.Codec(bpe.read_file(tokenizer("byte_bpe_50k.tiktoken")), split_pattern())
    codec.sizes = codec.sizes + 1
    assert np.frombuffer(codec.encode([LOREM])[0], np.uint32).tolist() == reference_encoding.encode_ordinary(LOREM)


def test_bpe_round_trip(odd, reference_encoding):
    got = bpe.round_trip(odd, tokenizer("byte_bpe_50k.tiktoken"), split_pattern()).collect()
    want = Counter((i, len(e := reference_encoding.encode_ordinary(t or "")), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ODD)
    assert Counter(tuple(r)[:4] for r in got) == want
    by = {r["doc_id"]: r for r in got}
    assert by[10]["n_split"] > 0 and by[4]["n_split"] == 0


def test_bpe_offsets_column(odd):
    got = bpe.encode(odd, tokenizer("byte_bpe_50k.json"), offsets=True).where("doc_id = 4").first()
    assert (got["char_start"][0], got["char_end"][-1]) == (0, 4)


def test_token_output(spark, odd, tmp_path):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    for k, encoding in enumerate(("dictionary", "delta")):
        out = f"file://{tmp_path}/{k}"
        token_output.write_tokens(odd, out, path, encoding=encoding)
        got = sorted((tuple(r) for r in token_output.token_index(spark, out).collect()), key=lambda r: r[1])
        at = 0
        for doc, (i, start, n, crc) in zip(sorted(ODD, key=lambda x: (x[0] is not None, x[0] or 0)), got, strict=True):
            ids = [*tok.encode(doc[1] or "", add_special_tokens=False).ids, 0]
            assert (i, start, n, crc) == (doc[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            at += n
        assert token_output.read_lengths(spark, out).count() == len(ODD)
        assert [r["doc_id"] for r in token_output.read_tokens(spark, out, 5, 6).orderBy("doc_id").collect()] == [5, 6]


# ---------------------------------------------------------------------------------- language, CNN


def test_language_id(docs, odd):
    got = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 20 and np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.9
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    by = {r["doc_id"]: r for r in language_id.language_id(odd).collect()}
    assert {by[k]["lang_pred"] for k in (1, 2, 3)} == {"und"} and by[1]["score"] == 0 and by[6]["lang_pred"] == "es"
    assert {r["lang_pred"] for r in language_id.predict(odd, None).collect()} == {"und"}


def test_quality_classifier(spark, labels, odd):
    docs, labels = [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")]
    got = quality_classifier.quality_classifier(docs, labels).join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got if r["held_out"]]) >= 0.9
    net = quality_classifier.Net()
    assert all(0 <= r["score"] <= 1 for r in quality_classifier.predict(odd, net).collect())
    assert {r["score"] for r in quality_classifier.quality_classifier(odd, labels.limit(0)).collect()} == {0.5}


def test_gradients_are_slopes():
    rng, net = np.random.default_rng(3), quality_classifier.Net()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    raw = rng.integers(0, 256, 1500).astype(np.uint8)
    offsets = np.array([0, 900, 900, 1500])
    first = quality_classifier.chunk_counts(offsets)
    data = quality_classifier.chunks(raw, offsets, first, np.arange(first[-1]))
    assert len(data) == 5
    y, w = np.array([1.0, 0, 1]), np.ones(3)

    def loss():
        z = net.logits(net.pooled(data), first)
        return np.mean(np.log1p(np.exp(z)) - y * z)

    g = net.gradients(data, first, y, w)
    for key in net.p:
        at = np.unravel_index(np.argmax(np.abs(g[key])), g[key].shape)
        keep, step = net.p[key][at], 1e-5
        net.p[key][at] = keep + step
        up = loss()
        net.p[key][at] = keep - step
        assert (up - loss()) / (2 * step) == pytest.approx(g[key][at], rel=0.02, abs=1e-5)
        net.p[key][at] = keep


# ------------------------------------------------------------------------------- licenses, mixing


def test_license_scan(spark):
    apache = license_scan.TEMPLATES["Apache-2.0"][1]
    rows = [(1, "texto\nReleased under the MIT License.\nmás"), (2, "no block"), (3, None), (4, ""), (5, f"a\n{apache.replace('. ', '.' + chr(10))}\nb"), (6, "This work is licensed under the GNU General Public License, version 2."), (7, "Driving licences cost money here and there"), (1, "texto\nReleased under the MIT License.\nmás")]
    got = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = Counter((r["doc_id"], r["license"], r["n_differences"]) for r in got if r["confirmed"])
    assert found == {(1, "MIT", 0): 2, (5, "Apache-2.0", 0): 1, (6, "GPL-2.0", 0): 1}
    assert [r["confirmed"] for r in got if r["doc_id"] == 7] == [False]


def test_license_wording_differences():
    diff, found, n = license_scan.differences("Licensed under the Apache License, Version 3.0.", "Licensed under the Apache License, Version 2.0.")
    assert diff == ["-2.0", "+3.0"] and (found, n) == (6, 7)


def licenses(text):
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    return [(r[2], text[r[0] : r[1]]) for r in scanner.scan(text) if r[5]]


def test_license_scan_gives_every_license_of_a_block(spark):
    lines = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "All rights reserved."]
    names = ["MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0", "Proprietary"]
    assert licenses("\n".join(lines)) == [(n, x.rstrip(".")) for n, x in zip(names, lines, strict=True)]
    assert [n for n, _ in licenses("\n".join(lines[:1] * 3))] == ["MIT"] * 3
    got = license_scan.license_scan(spark.createDataFrame([(1, "a\n" + "\n".join(lines[:2]))], "doc_id long, text string")).collect()
    assert sorted((r["start"], r["license"], r["confirmed"]) for r in got) == [(2, "MIT", True), (34, "Apache-2.0", True)]


def test_license_scan_confirms_only_the_named_license():
    bsd2, gpl3 = license_scan.TEMPLATES["BSD-2-Clause"][1], next(t for t in license_scan.TEMPLATES["GPL-3.0"] if t.startswith("This program"))
    third = " 3. Neither the name of Acme Inc. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    numbered = bsd2.replace("met: R", "met: 1. R").replace("disclaimer. R", "disclaimer. 2. R")
    want = {
        "Released under the ISC License.": ["ISC"], "Distributed under the MIT License.": ["MIT"], "Released under the Foo License.": [], "Licensed under CC BY-ND 4.0.": ["CC-BY-ND-4.0"],
        "Licensed under CC BY-NC 3.0.": [], "Licensed under the Apache License, Version 1.1": [], "This work is licensed under the GNU Lesser General Public License, version 3.": ["LGPL-3.0"],
        "This work is licensed under the GNU Affero General Public License, version 3.": ["AGPL-3.0"], "This work is licensed under the GNU General Public License, version 3.0.": ["GPL-3.0"],
        gpl3.replace("GNU General", "GNU Lesser General"): ["LGPL-3.0"], gpl3.replace("GNU General", "GNU Foo Affero General"): ["AGPL-3.0"], gpl3.replace("version 3", "version 4"): [],
        bsd2: ["BSD-2-Clause"], numbered: ["BSD-2-Clause"], numbered + third: ["BSD-3-Clause"], f"{bsd2} 3. Neither the name nor anything else may be used.": [],
        "SPDX-License-Identifier: MIT": ["MIT"], "SPDX-License-Identifier: MIT-0": [], "This is not released under the MIT License.": [], "Not released under the MIT License.": [],
    }
    assert {t: [n for n, _ in licenses(t)] for t in want} == want


def test_license_scan_compares_the_text_around_triggers(spark):
    mit, bsd = license_scan.TEMPLATES["MIT"][1], license_scan.TEMPLATES["BSD-2-Clause"][1]
    wrapped = ["\n".join(textwrap.wrap(t, 72)) for t in (mit, bsd)]
    texts = [f"antes\n\n{t}\n\n{LOREM}" for t in wrapped] + [f"{LOREM} {mit} {LOREM}"]
    assert [[n for n, _ in licenses(t)] for t in texts] == [["MIT"], ["BSD-2-Clause"], ["MIT"]]
    assert [n for n, _ in licenses("SPDX-License-Identifier: (MIT OR Apache-2.0) AND ISC")] == ["MIT", "Apache-2.0", "ISC"]
    names = ["Released under GPL v3", "CC BY-NC 4.0", "CC0", "Lizenz", "Released under MIT"]
    got = license_scan.license_scan(spark.createDataFrame(list(enumerate([*names, "Mit dem Hund"])), "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["start"], r["end"]) for r in got} == {(k, 0, len(n)) for k, n in enumerate(names)}
    assert {r["license"] for r in got if r["doc_id"] < 3} == {"GPL-3.0", "CC-BY-NC-4.0", "CC0-1.0"}
    for name, listed in license_scan.TEMPLATES.items():  # a wording without a naming word that is a trigger could lie out of reach
        assert all(re.search(license_scan.TRIGGERS, t) and license_scan.NEVER in license_scan.Words(t).extra for t in listed), name


def test_mixing_meets_targets(docs, labels, odd):
    soft = stored(mixing.posteriors(docs, mixing.fit(docs, labels), ["doc_id"]), "test-soft")
    rate, target, reached = mixing.fit_rates(soft)
    assert np.allclose(reached, target, atol=2e-3 * target.sum())
    rows = soft.withColumn("rate", rate).collect()
    p, n = np.array([r["__p"] for r in rows]), np.array([r["__n"] for r in rows])
    assert np.allclose(p.sum(1), 1) and min(r["rate"] for r in rows) >= 0
    r = np.ones(len(rows))  # brute force: projected gradient on all documents
    for _ in range(3000):
        r = np.maximum(0, r - 0.5 * p @ ((p.T @ (n * r) - target) / np.maximum(p.T @ n, 1)))
    assert np.allclose(p.T @ (n * r), target, atol=2e-3 * target.sum())
    assert mixing.mix(odd, labels).count() == len(ODD)
    assert mixing.mixed(odd, labels.limit(0)).columns == odd.columns


def test_mixing_raises_scarce_domains_to_their_weights(spark, docs, labels):
    weights = np.array([mixing.WEIGHTS[k] for k in mixing.DOMAINS])
    soft = lambda rows: spark.createDataFrame([(100, [float(x) for x in p]) for p in rows], "__n long, __p array<double>")
    rate, target, reached = mixing.fit_rates(soft([(1, 0, 0)] * 90 + [(0, 1, 0)] * 9 + [(0, 0, 1)]))
    assert np.allclose(target, weights * 10_000) and np.allclose(reached, target, atol=20)
    assert max(r["r"] for r in soft([(0, 0, 1)]).select(rate.alias("r")).collect()) == pytest.approx(6, abs=0.2)
    _, target, reached = mixing.fit_rates(soft([(1, 0, 0)] * 90 + [(0, 0, 1)]))  # nothing is low: its target stays and is missed
    assert np.allclose(target, weights * 10_000) and np.allclose(reached, target * [1, 0, 1], atol=20)
    _, target, reached = mixing.fit_rates(soft([(0, 1, 0)] * 9 + [(0, 0, 1)]))
    assert np.allclose(target, weights * 1000) and np.allclose(reached, target * [0, 1, 1], atol=20)
    traces = soft([(0.999, 0.001, 0), (0.99999, 0.00001, 0)] * 450 + [(0, 0, 1)] * 9)  # traces of low in clean documents crowd nothing out
    rate, _, reached = mixing.fit_rates(traces)
    assert [round(r["r"], 1) for r in traces.where("__p[0] > 0").select(rate.alias("r")).distinct().collect()] in ([1.0], [1.0, 1.0])
    row = mixing.mix(docs, labels).first()
    assert np.allclose([row[f"reached_{k}"] for k in mixing.DOMAINS], [row[f"target_{k}"] for k in mixing.DOMAINS], atol=100)


# ------------------------------------------------------------------------------------------- warc


def test_warc(spark):
    big = "<p>" + "é" * 200
    rows = [(3, "http://a/x y", big, "c"), (1, "http://b", big, "c"), (2, None, "<p>short", "c"), (4, "http://d", "<p>short", "c"), (5, "http://e", None, "c"), (6, "http://f", "z" * 200_000, "c"), (None, "http://g", big, "c"), (1, "http://b", big, "c")]
    got = warc.warc(spark.createDataFrame(rows, "page_id long, url string, html string, size string")).collect()
    assert len(got) == len(rows)
    sha = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    again = [h == big and k != 1 for k, (_, _, h, _) in enumerate(rows)]  # of the equal rows of page 1 one is the response
    want = Counter((i, len((h or "").encode()), sha(h), "revisit" if a else "response", 1 if a else None) for a, (i, _, h, _) in zip(again, rows, strict=True))
    assert Counter(tuple(r)[:5] for r in got) == want
    assert warc.warc(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_is_plain_zstd_with_its_dictionary(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    dictionary = warc.train_dictionary(pages)
    out = f"{tmp_path}/w"
    warc.write_warc(warc.plan(pages).coalesce(1), out, dictionary)
    (file,) = tmp_path.glob("w/part-*")
    data = file.read_bytes()
    assert data[:4] == warc.DICTIONARY_MAGIC and data[8 : 8 + len(dictionary)] == dictionary
    kinds = Counter(h["warc-type"] for h, _ in warc.records_of(data))
    assert kinds["warcinfo"] == 1 and sum(kinds.values()) == pages.count() + 1


# --------------------------------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, docs, labels):
    df, before = docs, None
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        ids = Counter(r["doc_id"] for r in df.select("doc_id").collect())
        df = stored(stage(spark, df, SF), "test-stage")
        now = Counter(r["doc_id"] for r in df.select("doc_id").collect())
        if name == "quality rules":
            assert now == Counter(r["doc_id"] for r in quality_rules.quality_rules(docs).where("kept").collect())
        elif name == "exact dedup":
            last = {low(rows[i]): i for i in sorted(ids)}
            assert now == Counter(last.values())
        elif name == "near-dedup":
            roots, _ = brute_components([(i, rows[i]) for i in ids])
            assert now == Counter(i for i in ids if roots[i] == i)
        elif name.startswith("mixing"):
            copies = {r["doc_id"]: r["copies"] for r in mixing.mix(before, labels).collect()}
            assert now == Counter({i: k for i, k in copies.items() if k})
        if name != "byte-level BPE":
            assert df.columns == docs.columns
        before = df
    assert df.where("NOT round_trip OR round_trip IS NULL").count() == 0
    assert df.where(F.size("ids") != F.col("n_tokens")).count() == 0
