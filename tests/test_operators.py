"""Repair, keys, text, rubric, scoring, sources, streaming and configuration on small cases."""

import json
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from tesela.errors import StructuralFailure
from tesela.functions import text as X
from tesela.functions.time import Period, checked, utc
from tesela.operators import keys, quality, repair, rubric, scoring, select, temporal, translate
from tesela.sources import config, logs, sinks, tables
from tesela.streaming import logs as stream


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text", ["l’été “ici”", "🦜🌵 ñandú", "#空港の朝 – 5 €", "Škoda ž", "ascii only"])
def test_damage_is_taken_back(spark, text):
    broken = one(spark, text, repair.mangled)
    assert (broken == text) == text.isascii()
    assert one(spark, broken, X.unmangled) == text and one(spark, text, X.unmangled) == text


def test_unmangled_leaves_null(spark):
    assert one(spark, None, X.unmangled) is None


def test_texts(spark):
    assert one(spark, "\x1c  a \n\x1f", X.strip) == "a"
    assert one(spark, " NaN ", X.safe_text) == ""
    assert one(spark, " «Alto  X» ", X.normalised) == "alto x"
    assert [one(spark, v, X.truthy) for v in ("true", " SI ", "1", "no", None)] == [True, True, True, False, False]
    assert [X.slug(t) for t in ("7_Año — Ñu!", "__a--b  ", "日本", "é" * 40)] == ["7_ano_nu", "a_b", "crit", "e" * 28]


@pytest.mark.parametrize(("error", "state"), [(AttributeError("sin atributo"), "PERMANENTE"), (RuntimeError("Unauthenticated caller"), "PERMANENTE"), (RuntimeError("daily Quota used up"), "LIMITE_TASA"), (RuntimeError("HTTP 502 from the gateway"), "ERROR_SERVIDOR"), (RuntimeError("Recitation"), "BLOQUEADO"), (TimeoutError("tarde"), "TIEMPO_AGOTADO"), (RuntimeError("otra cosa"), "ERROR")])
def test_failures(spark, error, state):
    assert X.failure_of(error) == state
    kind = "structural" if isinstance(error, AttributeError) else "timeout" if isinstance(error, TimeoutError) else ""
    df = spark.createDataFrame([(str(error), kind)], "m string, k string")
    assert df.select(X.failure_class(F.col("m"), F.col("k"))).first()[0] == state


def test_repair_stops_before_writing(spark):
    doc = json.dumps({"id": "2062323406914351181", "text": "arenâ€™t\nx", "possibly_sensitive": True, "_author": {"name": "JosÃ©"}}, ensure_ascii=False)
    src = spark.createDataFrame([("2.06E+18", "aren", "", "x", doc)], "id string, text string, possibly_sensitive string, author_name string, raw_json string")
    got = repair.repair(src).first()
    assert (got["id"], got["text"], got["possibly_sensitive"], got["author_name"]) == ("2062323406914351181", "aren’t\nx", "True", "José")
    with pytest.raises(ValueError, match="raw_json"):
        repair.repair(spark.createDataFrame([("1", "a", "{")], "id string, text string, raw_json string"))
    lossy = spark.createDataFrame([("1", "Ã?", '{"id": "1"}')], "id string, text string, raw_json string")
    with pytest.raises(ValueError, match="lost"):
        repair.repair(lossy)


def test_keys(spark):
    real = "2062323406914351181"
    df = spark.createDataFrame([(real, ""), ("2.06E+18", json.dumps({"id": real[:-1] + "2"})), ("", "")], "id string, raw_json string").withColumns({c: F.lit("u") for c in ("author_username", "created_at", "text")})
    got = keys.resolved(df).collect()
    assert [r["key_source"] for r in got] == ["flat", "json", "synthetic"] and got[2]["id"].startswith("local:")
    assert keys.synthetic_blake2s(df, "author_username", "created_at", "text").where("id RLIKE '^local:[0-9a-f]{16}$'").count() == 3
    base = keys.resolved(df).drop("key_source")
    assert keys.consolidate(base, base).count() == 3
    with pytest.raises(ValueError):
        keys.consolidate(base.unionByName(base), base)


def rub():
    level = lambda x: {"etiqueta": x, "puntos": float(x), "descriptor": f"el tweet {'no menciona' if x == '0' else 'menciona'} a México " + "x" * 60}
    return rubric.annotate({"criterios": [{"id_criterio": str(k), "nombre": f"CRITERIO {k} DE MÉXICO: X", "slug": s, "consigna": "c", "niveles": [level("0"), level("1")]} for k, s in enumerate(("c1", "c2"), 1)]})


def test_rubric():
    r = rub()
    other = {"criterios": [dict(c, nombre="otro") for c in reversed(r["criterios"])]}
    assert rubric.fingerprint(r) == rubric.fingerprint(other)
    other["criterios"][0]["niveles"] = [dict(n, descriptor="x") for n in other["criterios"][0]["niveles"]]
    assert rubric.fingerprint(r) != rubric.fingerprint(other)
    assert rubric.absence_levels(r) == {"c1": {"0"}, "c2": {"0"}}
    assert rubric.absence_levels(r, {"c1": [1]}) == {"c1": {"1"}, "c2": set()}
    assert rubric.short_name(r["criterios"][0]) == "Criterio 1"
    assert rubric.anchoring(r, ["méxico"])["anchored"] == 4 and rubric.anchoring(r, ["méxico"])["prompts"] == ["c1", "c2"]
    assert rubric.absence_levels(r, ["0", 1]) == {"c1": {"0", "1"}, "c2": {"0", "1"}} and rubric.absence_levels(r, None) == {"c1": set(), "c2": set()}
    twice = rubric.annotate({"criterios": [{"nombre": "A", "id_criterio": "1", "niveles": []}, {"nombre": "A", "id_criterio": "1", "niveles": []}]})
    assert rubric.slugs(twice) == ["1_a", "1_a_2"]


def test_run_resumes_and_breaks(spark, tmp_path):
    sel = spark.createDataFrame([(f"t{k:02}", "p" * (k + 1), "") for k in range(6)], "id string, _payload string, contexto_incompleto string")
    path = str(tmp_path / "log")
    levels, texts = rubric.levels(spark, rub()), {"c1": "i", "c2": "j"}
    read = lambda: logs.read_log(spark, path) if (tmp_path / "log").exists() else scoring.empty_log(spark)

    def append(df, k):
        block = logs.next_block(read())
        logs.append_log(df, path, block)
        return logs.appended(spark, path, block)

    def scorer(payload, slug, instruction):
        if slug == "c2":
            raise RuntimeError("503 UNAVAILABLE")
        return {"aplicable": True, "nivel": " '1' ", "justificacion": "x"}

    said = []
    got = scoring.run(sel, levels, texts, [scorer], read, append, block=4, attempts=1, say=said.append, work_dir=str(tmp_path))
    assert (got["ok"], got["failed"], got["stopped"], got["reused"], got["left"]) == (6, 6, False, 0, 0)
    assert len(said) == 2 and said[-1].startswith("12/12 pairs, 6 failed") and not list(tmp_path.glob("trabajo-*"))
    assert logs.read_log(spark, path).where("slug = 'c1' AND puntaje = 1.0 AND nivel = '1'").count() == 6

    def fallback(payload, slug, instruction):
        return {"aplicable": False, "nivel": None, "justificacion": "y"}

    got = scoring.run(sel, levels, texts, [scorer, fallback], read, append, block=6, attempts=1)
    assert (got["ok"], got["reused"]) == (6, 6)
    assert logs.read_log(spark, path).where("justificacion = 'y' AND detalle = ' (resuelto por respaldo directo)'").count() == 6
    assert scoring.smoke(sel, levels, texts, [fallback]).count() == 2

    def broken(payload, slug, instruction):
        raise NameError("x")

    with pytest.raises(StructuralFailure):
        scoring.answer([broken], "p", "c1", "i")

    def down(payload, slug, instruction):
        raise RuntimeError("503 UNAVAILABLE")

    got = scoring.run(spark.range(9).selectExpr("concat('u', id) AS id", "'p' AS _payload", "'' AS contexto_incompleto"), levels, texts, [down], read, append, block=3, limit=5, attempts=1)
    assert got["stopped"] and (got["failed"], got["left"]) == (12, 6)


def test_chain_of_scorers():
    calls = []

    def block(payload, slug, instruction):
        calls.append("block")
        raise RuntimeError("prohibited content")

    def busy(payload, slug, instruction):
        calls.append("busy")
        raise RuntimeError("quota")

    def good(payload, slug, instruction):
        return {"aplicable": True, "nivel": "1"}

    waits = []
    assert scoring.answer([block, good], "p", "c", "i", wait=waits.append)[2] == scoring.FALLBACK and calls == ["block"] and not waits
    got, state, detail = scoring.answer([busy, block], "p", "c", "i", attempts=3, wait=waits.append)
    assert (got, state, waits, calls[1:]) == (None, "BLOQUEADO", [0, 1], ["busy"] * 3 + ["block"]) and detail.startswith("respaldo directo")
    slow = lambda payload, slug, instruction: time.sleep(5)
    began = time.monotonic()
    assert scoring.answer([slow], "p", "c", "i", attempts=1, timeout=0.05)[1] == "TIEMPO_AGOTADO" and time.monotonic() - began < 3
    with pytest.raises(KeyError):
        scoring.limited(lambda: {}["x"], 1)


def test_retest_counts_missing_levels_as_equal(spark):
    rows = lambda *v: spark.createDataFrame([(str(k), "c", x) for k, x in enumerate(v)], "tweet_id string, slug string, nivel string")
    got = {r["slug"]: r["agreement"] for r in quality.retest(rows("1", None, "2"), rows("1", None, "3")).collect()}
    assert got == {"c": 0.666667, "(global)": 0.666667}


def test_payload_marks(spark):
    df = spark.createDataFrame([("@x hola", None, "TRUE", None)], "text_completo string, in_reply_to_user_id string, is_retweet string, lang string")
    got = select.payload(df).first()
    assert got["contexto_incompleto"] == "reply;retweet" and 'idioma="desconocido"' in got["_payload"]


def test_translate(spark):
    def by(text):
        if text == "b":
            raise RuntimeError("blocked")
        return {"idioma_detectado": "inglés", "ya_esta_en_espanol": False, "traduccion": "t"}

    df = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, text_completo string")
    assert {r["tweet_id"]: r["estado"] for r in translate.translate(df, by).collect()} == {"1": "OK", "2": "BLOQUEADA"}


def test_selection_keeps_words_that_mean_missing_elsewhere(spark):
    df = spark.createDataFrame([("1", "nan"), ("2", " \x1c "), ("3", None), ("4", "None")], "id string, text_completo string")
    assert [r["id"] for r in select.select(df).orderBy("id").collect()] == ["1", "4"]
    assert select.sample_for(df, "gold", 42, 2).count() == 2 and select.sample_for(df, "cost", 42).count() == 4


def test_times_of_mixed_layouts(spark):
    texts = ["2024-10-10T20:19:24", "2024-10-10 7:02:11", "Thu Oct 10 20:19:24 +0000 2024", "10/31/2024 5:00", "Thu, 10 Oct 2024 20:19:24 +0200", "ayer", "", None]
    got = [r["t"] for r in spark.createDataFrame(list(enumerate(texts)), "k int, x string").select("k", utc(F.col("x")).cast("string").alias("t")).orderBy("k").collect()]
    assert got == ["2024-10-10 20:19:24", "2024-10-10 07:02:11", "2024-10-10 20:19:24", "2024-10-31 05:00:00", "2024-10-10 18:19:24", None, None, None]


def test_prepare_report_and_periods(spark):
    periods = [Period("a", date(2024, 1, 1), date(2024, 1, 3)), Period("b", date(2024, 2, 1))]
    corpus = spark.createDataFrame([(f"t{k}", "2024-01-01T12:00:00" if k < 30 else "2024-01-02T12:00:00" if k < 40 else "ayer", "es", k) for k in range(41)] + [("t0", "2024-01-02T12:00:00", "en", 99)], "id string, created_at string, lang string, fila int")
    ratings = spark.createDataFrame([(f"t{k}", "c1", "1", "OK", "reply" if k == 1 else "") for k in range(41)] + [("zz", "c1", "1", "OK", "")], "tweet_id string, slug string, nivel string, estado string, contexto_incompleto string")
    ready = temporal.prepare(ratings, corpus, "created_at", "UTC", periods, seq="fila")
    got = temporal.prepare_report(ready, ratings, corpus).first().asDict()
    assert (got["ratings"], got["tweets"], got["days"], got["per_day"], got["low_coverage"]) == (40, 40, 2, 20.0, True)
    assert (got["orphans"], got["orphan_tweets"], got["no_match"], got["unreadable"]) == (1, 1, False, 1)
    assert {r["periodo"]: (r["days"], r["tweets"]) for r in temporal.by_period(ready, periods).collect()} == {"a": (2, 40), "b": (0, 0)}
    assert temporal.prepare_report(ready.limit(0), ratings, corpus.limit(0)).first()["no_match"]


def test_tables_and_csv(spark, tmp_path):
    df = spark.createDataFrame([("1", 'dice "hola",\nsí', "NA"), ("2", "日本", None)], "id string, text_completo string, x string")
    path = str(tmp_path / "a.csv")
    assert sinks.write_csv(df, path) == 2
    back, seen = tables.read_corpus(spark, path)
    assert [tuple(r) for r in back.orderBy("id").collect()] == [("1", 'dice "hola",\nsí', "NA"), ("2", "日本", None)] and seen["rows"] == 2
    assert sinks.verify_csv(spark, path, "text_completo") == {"rows": 2, "accents": 1, "cjk": 1}
    (tmp_path / "b.csv").write_bytes("id,text_completo\n1,caf\xe9 \x80\n".encode("latin-1"))
    assert tables.read_table(spark, str(tmp_path / "b.csv")).first()["text_completo"] == "café €"
    (tmp_path / "mix").mkdir()
    for k in range(6):  # one late byte in one file of several
        (tmp_path / "mix" / f"{k} ñ.csv").write_bytes(b"id,text_completo\n" + b"1,x\n" * 300_000 * (k == 5) + f"{k},niño\n".encode("cp1252" if k == 5 else "utf-8"))
    assert tables.read_table(spark, str(tmp_path / "mix")).where("text_completo = 'niño'").count() == 6
    with pytest.raises(FileNotFoundError, match="stage"):
        tables.require(spark, str(tmp_path / "none"), "x", "reparar")
    with pytest.raises(ValueError):
        tables.read_source(spark, path)
    cube = [{"fecha": "2024-01-01", "slug": "c", "clase": "valencia", "nivel": "1", "idioma": "</script><b>", "autosuficiente": True, "n": 1}]
    text = sinks.page("t", cube, [{"slug": "c", "name": "C", "levels": ["1"]}], [], {"a": [{"x": 1}]})
    assert text.count("</script>") == 1 and "autosuficientes" in text and "http" not in text.replace("http://www.w3.org/2000/svg", "")


def test_stream_resolves(spark, tmp_path):
    def write(k, state):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"tweet_id": "t", "slug": "c", "estado": state, "seq": k}) + "\n")

    for k, state in enumerate(["OK", "ERROR", "NO_APLICABLE", "ERROR"]):
        write(k, state)
    q = stream.follow(stream.read_stream(spark, str(tmp_path / "in"), 1), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert [(r["estado"], r["seq"]) for r in stream.current(spark, str(tmp_path / "out")).collect()] == [("NO_APLICABLE", 2)]
    assert len(list((tmp_path / "out").glob("v*/bucket=*"))) == 2  # the last version and the one before
    (tmp_path / "in" / "9.json").write_text("".join(json.dumps({"tweet_id": f"t{k}", "slug": "c", "estado": "OK", "seq": 10 + k}) + "\n" for k in range(50)))
    stream.follow(stream.read_stream(spark, str(tmp_path / "in"), 1), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert stream.current(spark, str(tmp_path / "out")).count() == 51


def test_config(tmp_path, monkeypatch):
    path = tmp_path / "c.toml"
    path.write_text('[comun]\ncorpus = "a"\nrubric = "r"\nlog = "l"\noutput = "o"\n[perfiles.p]\nseed = 7\n[perfiles.q]\nnada = 1\n')
    assert config.load(path, "p").seed == 7
    for bad in ("q", "z"):
        with pytest.raises(config.ConfigError):
            config.load(path, bad)
    monkeypatch.delenv("SOME_KEY", raising=False)
    (tmp_path / ".env").write_text("SOME_KEY='v'\n")
    assert config.secret("SOME_KEY", tmp_path) == "v"
    with pytest.raises(ValueError):
        checked([Period("a", date(2024, 1, 1)), Period("b", date(2024, 1, 2))])
