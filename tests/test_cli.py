"""The command line, from a log to its exports."""

import json

import pytest

from tesela import cli
from tesela.operators import rubric
from tesela.sources import logs

from .test_operators import rub


@pytest.fixture
def project(tmp_path):
    rubric.save(rub(), tmp_path / "r.json")
    (tmp_path / "c.csv").write_text('id,text_completo,lang,created_at\nt1,"él dice\nsí",es,2024-01-02T12:00:00\nt2,b,en,2024-01-03 7:02:11\n', encoding="utf-8")
    (tmp_path / "log").mkdir()
    rec = lambda t, s, e, n, q: json.dumps({"tweet_id": t, "slug": s, "estado": e, "nivel": n, "puntaje": float(n) if n else None, "aplicable": bool(n), "seq": q})
    (tmp_path / "log" / "a.json").write_text("\n".join([rec("t1", "c1", "ERROR", None, 1), rec("t1", "c1", "OK", "1", 2), rec("t2", "c1", "NO_APLICABLE", None, 3), "{ rota"]))
    text = f'[comun]\ncorpus = "{tmp_path}/c.csv"\nrubric = "{tmp_path}/r.json"\nlog = "{tmp_path}/log"\noutput = "{tmp_path}"\nperiods = [{{name = "a", start = 2024-01-01}}]\n[perfiles.p]\n'
    (tmp_path / "config.toml").write_text(text)
    return tmp_path


def call(project, *args):
    return cli.main([*args, "--perfil", "p", "--config", str(project / "config.toml")])


def test_stages(spark, project):
    assert [call(project, s) for s in ("rubrica", "auditar", "exportar", "graficar")] == [0, 0, 0, 0]
    wide = (project / "ancho.csv").read_text(encoding="utf-8-sig")
    assert "c1_nivel" in wide and "él dice\nsí" in wide
    assert "Saliencia" in (project / "graficas.html").read_text(encoding="utf-8")


def translator(text):
    if text == "b":
        raise RuntimeError("429")
    return {"idioma_detectado": "español", "ya_esta_en_espanol": True, "traduccion": "otra"}


def scorer(payload, slug, instruction):
    return {"aplicable": "dice" in payload, "nivel": "1", "justificacion": "j"}


def test_translate_run_and_consolidate(spark, project):
    text = (project / "config.toml").read_text().replace("[perfiles.p]", f'translated = "{project}/t.csv"\ntranslation_log = "{project}/tlog"\nattempts = 1\nsample = 0\n[perfiles.p]')
    (project / "config.toml").write_text(text)
    assert call(project, "traducir") == 1 and not (project / "tlog").exists()
    assert call(project, "traducir", "--confirmar", "--traductor", "tests.test_cli:translator") == 0
    records = [json.loads(x) for f in (project / "tlog").glob("part-*") for x in f.read_text().splitlines()]
    assert {r["tweet_id"]: r["estado"] for r in records} == {"t1": "OK", "t2": "FALLIDA"}
    assert call(project, "traducir", "--confirmar", "--traductor", "tests.test_cli:translator") == 0  # only what failed again
    records = [json.loads(x) for f in (project / "tlog").glob("part-*") for x in f.read_text().splitlines()]
    assert sorted(r["tweet_id"] for r in records) == ["t1", "t2", "t2"]
    assert "él dice\nsí" in (project / "t.csv").read_text(encoding="utf-8-sig").split("traducción")[1][40:]
    assert call(project, "correr", "--confirmar", "--prueba", "--scorer", "tests.test_cli:scorer") == 0
    assert call(project, "correr", "--confirmar", "--scorer", "tests.test_cli:scorer") == 0
    log = logs.read_log(spark, str(project / "log"))
    assert log.where("estado = 'OK'").count() == 2 and log.where("estado = 'NO_APLICABLE'").count() == 2
    for name, rows in (("base", "2062323406914351181,u,2024,a,{}\n"), ("extra", "2062323406914351181,u,2024,a,{}\n,v,2025,b,{}\n")):
        (project / f"{name}.csv").write_text(f"id,author_username,created_at,text,raw_json\n{rows}")
    assert call(project, "consolidar", "--base", f"{project}/base.csv", "--extra", f"{project}/extra.csv", "--destino", f"{project}/u", "--partes") == 0
    assert spark.read.option("header", True).csv(f"{project}/u").count() == 2


def test_gate_and_codes(spark, project):
    assert call(project, "correr") == 1
    assert call(project, "reparar", "--forzar") == 2
    assert cli.main(["nada"]) == 2
    assert cli.main(["auditar", "--perfil", "otro", "--config", str(project / "config.toml")]) == 2
