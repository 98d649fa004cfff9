"""The state algebra of the log, against a fold over generated logs."""

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tesela.operators import log as L
from tesela.schema import FAILED_STATES, LEVEL_STATES, RESULT_STATES, kept_states
from tesela.sources import logs

STATES = [*RESULT_STATES, *FAILED_STATES]
RECORDS = st.lists(st.tuples(st.sampled_from("pqr"), st.sampled_from("xy"), st.sampled_from(STATES)), max_size=25)
QUIET = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, records):
    return spark.createDataFrame([(t, s, e, k) for k, (t, s, e) in enumerate(records)], "tweet_id string, slug string, estado string, seq long")


def pairs(df):
    return {(r["tweet_id"], r["slug"]) for r in df.collect()}


def fold(records):
    """The resolved state of each pair, one record after the other."""
    out = {}
    for t, s, e in records:
        if e in RESULT_STATES or out.get((t, s)) not in RESULT_STATES:
            out[t, s] = e
    return out


def runs_of(flags):
    """(first, last, length) of the runs of False among (position, flag)."""
    out, run = [], []
    for k, good in [*flags, (None, True)]:
        if good and run:
            out.append((run[0], run[-1], len(run)))
        run = [] if good else [*run, k]
    return out


def spans(df):
    return sorted(tuple(r) for r in df.select("first_seq", "last_seq", "length").collect())


@QUIET
@given(records=RECORDS)
def test_resolution_scopes_and_audit_equal_a_fold(spark, records):
    df, want = frame(spark, records), fold(records)
    assert {(r["tweet_id"], r["slug"]): r["estado"] for r in L.resolve(df).collect()} == want
    for scope, states in (("fallidos", RESULT_STATES), ("sin-nivel", LEVEL_STATES), ("todo", ())):
        assert pairs(L.done(df, scope)) == {(t, s) for t, s, e in records if e in states}
    got = L.audit(df, 3).first()
    repeats = [sum((t, s) == p for t, s, _ in records) for p in want]
    assert (got["records"], got["unreadable"], got["pairs"], got["repeated"], got["most"]) == (len(records), 3, len(want), sum(n > 1 for n in repeats), max(repeats, default=0))
    assert (got["resolved"], got["failed"]) == (sum(e in RESULT_STATES for e in want.values()), sum(e not in RESULT_STATES for e in want.values()))


@QUIET
@given(records=RECORDS)
def test_streaks_equal_a_fold(spark, records):
    df = frame(spark, records)
    flags = [(k, e in RESULT_STATES) for k, (_, _, e) in enumerate(records)]
    assert spans(L.failure_streaks(df, 1)) == runs_of(flags)
    by = {s: runs_of([(k, g) for (k, g), r in zip(flags, records, strict=True) if r[1] == s]) for s in "xy"}
    assert spans(L.failure_streaks(df, 1, "slug")) == sorted(x for runs in by.values() for x in runs)
    rows = {t: (max(k for k, r in enumerate(records) if r[0] == t), any(r[2] in RESULT_STATES for r in records if r[0] == t)) for t in {r[0] for r in records}}
    assert spans(L.row_streaks(df, 1)) == runs_of(sorted(rows.values()))


def test_streaks_across_ranges_of_seq(spark):
    bad = [(0, "OK"), *[(k, "ERROR") for k in range(65_530, 65_540)], (131_071, "ERROR"), (131_072, "ERROR"), (131_073, "OK")]
    df = spark.createDataFrame([("t", "c", e, k) for k, e in bad], "tweet_id string, slug string, estado string, seq long")
    assert spans(L.failure_streaks(df)) == spans(L.failure_streaks(df, by="slug")) == [(65_530, 131_072, 12)]
    sparse = df.selectExpr("tweet_id", "slug", "estado", "seq << 40 AS seq")
    assert spans(L.failure_streaks(sparse)) == [(65_530 << 40, 131_072 << 40, 12)]


def test_estimate_counts_every_pair(spark):
    rng = random.Random(4)
    ids, slugs = [f"tw{k}" for k in range(9)], ["uno", "dos", "tres"]
    records = [(rng.choice([*ids, "fuera"]), rng.choice(slugs), rng.choice(STATES)) for _ in range(60)]
    got = {r["scope"]: (r["total"], r["recovered"], r["to_score"]) for r in L.rescore_estimate(spark.createDataFrame([(i,) for i in ids], "id string"), slugs, frame(spark, records)).collect()}
    for scope, states in (("fallidos", RESULT_STATES), ("sin-nivel", LEVEL_STATES), ("todo", ())):
        kept = len({(t, s) for t, s, e in records if e in states and t in ids})
        assert got[scope] == (27, kept, 27 - kept)
        assert L.pending(spark.createDataFrame([(i,) for i in ids], "id string"), slugs, frame(spark, records), scope).count() == 27 - kept


def test_unreadable_lines(spark, tmp_path):
    line = json.dumps({"tweet_id": "z9", "slug": "uno", "estado": "OK"})
    (tmp_path / "registro.jsonl").write_text(f'{line}\n{line[:17]}\n \n{json.dumps({"estado": "OK", "slug": "uno"})}\n{line}\n"texto"\n')
    assert logs.unreadable(spark, str(tmp_path)) == 3
    assert logs.read_log(spark, str(tmp_path)).count() == 2


def test_imported_files_keep_their_order(spark, tmp_path):
    """Later lines win over earlier ones, by file name and line, although Spark packs large splits first."""
    level = lambda n, k: json.dumps({"tweet_id": "a", "slug": "uno", "estado": "OK", "nivel": str(n), "justificacion": "j" * k})
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.jsonl").write_text("\n".join(level(1, 2000) for _ in range(400)))
    (folder / "2.jsonl").write_text(level(2, 1) + "\n" + level(3, 1) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(100_000))
    try:
        assert [r["nivel"] for r in L.resolve(logs.read_log(spark, str(folder))).collect()] == ["3"]
        seqs = [r["seq"] for r in logs.read_log(spark, str(folder)).orderBy("seq").collect()]
        assert len(set(seqs)) == 402
        logs.import_log(spark, str(folder), str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["nivel"] for r in L.resolve(logs.read_log(spark, str(tmp_path / "out"))).collect()] == ["3"]
    block = logs.next_block(logs.read_log(spark, str(tmp_path / "out")))
    logs.append_log(spark.createDataFrame([("a", "uno", "OK", "4"), ("b", "uno", "OK", "4")], "tweet_id string, slug string, estado string, nivel string"), str(tmp_path / "out"), block)
    assert {r["nivel"] for r in L.resolve(logs.read_log(spark, str(tmp_path / "out"))).collect()} == {"4"}
    assert logs.appended(spark, str(tmp_path / "out"), block).count() == 2


def test_correspondence(spark):
    log = frame(spark, [("z", "retirado", "OK")])
    with pytest.raises(ValueError, match="retirado"):
        L.check_correspondence(log, ["uno", "dos"])
    assert L.check_correspondence(log, ["uno", "dos"], force=True)
    with pytest.raises(ValueError, match="rubric"):
        L.check_correspondence(log, ["retirado"], "1f", "2e")


def test_breaker():
    rng = random.Random(7)
    for _ in range(30):
        rows = [(f"r{k:03}", [rng.choice(STATES) for _ in range(rng.randint(1, 3))]) for k in range(40)]
        streak, want = 2, None
        for _, states in rows:
            streak = 0 if set(states) & set(RESULT_STATES) else streak + 1
            if streak >= 4 and want is None:
                want = (True, streak)
        got = L.breaker_tripped([{"tweet_id": t, "estado": e} for t, states in rows for e in states], 2, 4)
        assert got == (want or (False, streak))


def test_unknown_scope():
    with pytest.raises(ValueError):
        kept_states("otros")
