"""Scoring: validation against the closed scale, cost, and the run over a pluggable scorer."""

from __future__ import annotations

import queue
import tempfile
import threading
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import StructuralFailure
from ..functions.text import failure_of, normalised, strip
from ..schema import RECORD, RESULT_STATES
from .log import breaker_tripped, pending


#: Fixed value: what a record's detail says if a later scorer of the chain gave the answer.
FALLBACK = " (resuelto por respaldo directo)"


class Scorer(Protocol):
    """Scores one payload on one criterion: {"aplicable", "nivel", "justificacion"}; raises on failure."""

    def __call__(self, payload: str, slug: str, instruction: str) -> dict: ...


def validate(raw: DataFrame, levels: DataFrame) -> DataFrame:
    """Raw answers (tweet_id, slug, aplicable, nivel, justificacion) as records: a label counts if it is exact, or else by
    its normalised form (the lowest level of several); points come from the rubric. The rubric is a broadcast dimension of
    some dozens of rows."""
    exact = levels.select(F.col("slug").alias("__s1"), F.col("nivel").alias("__exact"), F.col("puntos").alias("__p1"), F.col("numerica").alias("__n1"))
    loose = levels.select(F.col("slug").alias("__s2"), normalised(F.col("nivel")).alias("__label"), F.struct("ordinal", "nivel", "puntos", "numerica").alias("__l")).groupBy("__s2", "__label").agg(F.min("__l").alias("__l"))
    r = raw.withColumn("__given", F.col("nivel")).withColumn("__norm", normalised(F.col("nivel"))).drop("nivel")
    r = r.join(F.broadcast(exact), (F.col("slug") == F.col("__s1")) & (F.col("__given") == F.col("__exact")), "left")
    r = r.join(F.broadcast(loose), (F.col("slug") == F.col("__s2")) & (F.col("__norm") == F.col("__label")) & F.col("__given").isNotNull(), "left")
    on = F.coalesce(F.col("aplicable"), F.lit(False))
    level = F.coalesce("__exact", "__l.nivel")
    points = F.when(F.col("__exact").isNotNull(), F.when(F.col("__n1"), F.col("__p1"))).otherwise(F.when(F.col("__l.numerica"), F.col("__l.puntos")))
    state = F.when(~on, "NO_APLICABLE").when(level.isNull(), "FUERA_DE_ESCALA").otherwise("OK")
    detail = F.when(on & level.isNull(), F.concat(F.lit("nivel devuelto "), F.coalesce(F.concat(F.lit("'"), F.col("__given"), F.lit("'")), F.lit("None")), F.lit(" no está en la escala del criterio"))).otherwise("")
    rest = [c for c in raw.columns if c not in ("tweet_id", "slug", "aplicable", "nivel", "justificacion")]
    return r.select("tweet_id", "slug", on.alias("aplicable"), F.when(on, level).alias("nivel"), F.when(on & level.isNotNull(), points).alias("puntaje"), strip(F.coalesce("justificacion", F.lit(""))).alias("justificacion"), state.alias("estado"), detail.alias("detalle"), *rest)


def output_tokens(most_words: int = 60, reasoning: int = 0) -> float:
    return most_words * 1.6 + 40 + (0 if reasoning == 0 else 500 if reasoning < 0 else reasoning)


def cost(selection: DataFrame, instructions: Sequence[str], price_in: float, price_out: float, calls: int | None = None, most_words: int = 60, reasoning: int = 0) -> DataFrame:
    """rows, calls, mean input tokens (a quarter of the characters of instruction and payload) and the price."""
    n = len(instructions)
    each = sum((F.floor((F.length("_payload") + len(i)) / 4) for i in instructions), F.lit(0)) / max(n, 1)
    one = selection.agg(F.count("*").alias("rows"), F.coalesce(F.avg(each), F.lit(0.0)).alias("t"))
    made = F.lit(calls).cast("long") if calls is not None else F.col("rows") * n
    price = made * F.col("t") / 1e6 * price_in + made * output_tokens(most_words, reasoning) / 1e6 * price_out
    return one.select("rows", made.alias("calls"), F.round("t", 6).alias("tokens_in"), F.round(price, 6).alias("cost"))


def rows_in_flight(calls: int, criteria: int) -> int:
    return max(1, calls // max(criteria, 1))


def backoff(attempt: int, most: float = 30.0) -> None:
    """Waits 2, 4, 8, ... seconds before the next attempt, `most` at most."""
    time.sleep(min(2.0 ** (attempt + 1), most))


def limited(call: Callable[[], dict], seconds: float | None) -> dict:
    """The result of call(), or TimeoutError after so many seconds. The call itself cannot be ended and is left to itself."""
    if seconds is None:
        return call()
    done: queue.Queue = queue.Queue(1)

    def work() -> None:
        try:
            done.put((call(), None))
        except BaseException as e:  # noqa: BLE001  it is raised again by the caller
            done.put((None, e))

    threading.Thread(target=work, daemon=True).start()
    try:
        got, error = done.get(timeout=seconds)
    except queue.Empty:
        raise TimeoutError(f"no answer in {seconds:g} s") from None
    if error is not None:
        raise error
    return got


def answer(scorers: Sequence[Scorer], payload: str, slug: str, instruction: str, attempts: int = 3, wait: Callable[[int], None] = backoff, timeout: float | None = None) -> tuple[dict | None, str, str]:
    """The raw answer of the first scorer of a chain that gives one, or the failure state and detail of the last. The first
    scorer has `attempts`, those after it one. A block is not tried again by the same scorer, and the next one is asked, as
    it may answer or tell the reason. A structural failure ends the run. With an answer, the last value says by whom if it was not the first."""
    state, detail = "ERROR", ""
    for rank, scorer in enumerate(scorers):
        tries = attempts if rank == 0 else 1
        for k in range(tries):
            try:
                return limited(lambda s=scorer: s(payload, slug, instruction), timeout), "", FALLBACK if rank else ""
            except Exception as e:  # noqa: BLE001  a scorer may raise anything; it becomes a record
                state, detail = failure_of(e), f"{'respaldo directo: ' if rank else ''}{type(e).__name__}: {e}"[:300]
                if state == "PERMANENTE":
                    raise StructuralFailure(detail) from e
                if state == "BLOQUEADO":
                    break
                if k < tries - 1:
                    wait(k)
    return None, state, detail


def score(work: DataFrame, instructions: dict[str, str], scorers: Sequence[Scorer], levels: DataFrame, attempts: int = 3, wait: Callable[[int], None] = backoff, timeout: float | None = None) -> DataFrame:
    """Records for work (tweet_id, slug, _payload, contexto_incompleto). The unit is a pair, so a row's other criteria keep
    their answers. Each evaluation calls the scorer: write the result once and read that."""
    import pandas as pd

    raw = "tweet_id string, slug string, aplicable boolean, nivel string, justificacion string, __state string, __detail string, contexto_incompleto string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for t, s, p, c in zip(pdf["tweet_id"], pdf["slug"], pdf["_payload"], pdf["contexto_incompleto"], strict=True):
                got, state, detail = answer(scorers, p, s, instructions[s], attempts, wait, timeout)
                got = got or {}
                out.append((t, s, bool(got.get("aplicable")), got.get("nivel"), got.get("justificacion") or "", state, detail, c))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in raw.split(", ")])

    answers = work.select("tweet_id", "slug", "_payload", "contexto_incompleto").mapInPandas(run, raw)
    v = validate(answers, levels)
    failed = F.col("__state") != ""
    detail = F.when(failed, F.col("__detail")).otherwise(F.concat("detalle", "__detail"))
    return v.select("tweet_id", "slug", "aplicable", "nivel", "puntaje", "justificacion", F.when(failed, F.col("__state")).otherwise(F.col("estado")).alias("estado"), detail.alias("detalle"), "contexto_incompleto")


def smoke(selection: DataFrame, rubric_levels: DataFrame, instructions: dict[str, str], scorers: Sequence[Scorer], attempts: int = 1, timeout: float | None = None, id_col: str = "id") -> DataFrame:
    """The records of the first row (by id) on every criterion; nothing is logged."""
    one = selection.orderBy(id_col).limit(1).select(F.col(id_col).cast("string").alias("tweet_id"), "_payload", "contexto_incompleto")
    work = one.select("*", F.explode(F.array(*[F.lit(s) for s in instructions])).alias("slug"))
    return score(work, instructions, scorers, rubric_levels, attempts, timeout=timeout)


def numbered(rows: DataFrame, key: str, block: int, path: str) -> int:
    """Writes rows below path in the order of key, block rows in each folder __block=0, 1, ..., and returns how many blocks there
    are. Rows are counted by partition; only those counts come to the driver."""
    order = rows.repartitionByRange(key).sortWithinPartitions(key).withColumn("__id", F.monotonically_increasing_id())
    part, inside = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    order.withColumn("__part", part).withColumn("__inside", inside).drop("__id").write.mode("overwrite").parquet(f"{path}/rows")
    written = rows.sparkSession.read.parquet(f"{path}/rows")
    counts = {r["__part"]: r["n"] for r in written.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    starts, total = {}, 0
    for k in sorted(counts):
        starts[k], total = total, total + counts[k]
    if not total:
        return 0
    table = rows.sparkSession.createDataFrame(list(starts.items()), "__part long, __start long")
    dealt = written.join(F.broadcast(table), "__part").withColumn("__block", F.floor((F.col("__start") + F.col("__inside")) / F.lit(block)))
    dealt.drop("__part", "__inside", "__start").write.mode("overwrite").partitionBy("__block").parquet(f"{path}/blocks")
    return -(-total // block)


def progress(made: int, total: int, failed: int, seconds: float) -> str:
    """One line: pairs done, failures, pairs a second and the minutes that the rest takes at that rate."""
    rate = made / max(seconds, 1e-9)
    return f"{made:,}/{total:,} pairs, {failed:,} failed, {rate:.1f}/s, about {(total - made) / max(rate, 1e-9) / 60:.0f} min left"


def run(selection: DataFrame, rubric_levels: DataFrame, instructions: dict[str, str], scorers: Sequence[Scorer], read_log: Callable[[], DataFrame], append: Callable[[DataFrame, int], DataFrame], scope: str = "fallidos", block: int = 200, limit: int = 20, attempts: int = 3, id_col: str = "id", work_dir: str | None = None, wait: Callable[[int], None] = backoff, timeout: float | None = None, say: Callable[[str], None] = lambda line: None) -> dict:
    """Scores what is pending in blocks of so many rows. The work list is numbered and written once below work_dir (a folder that
    driver and executors share), and a block reads its own folder of it. append(records, k) commits a block and gives it back as written; between
    blocks the circuit breaker looks at its records. Returns totals and whether the breaker stopped the run."""
    spark, slugs = selection.sparkSession, list(instructions)
    path = f"{work_dir or shared_dir(spark)}/trabajo-{uuid.uuid4().hex}"
    rows = selection.select(F.col(id_col).cast("string").alias("tweet_id"), "_payload", "contexto_incompleto")
    todo = pending(selection, slugs, read_log(), scope, id_col).groupBy("tweet_id").agg(F.collect_set("slug").alias("__slugs"))
    blocks = numbered(todo.join(rows, "tweet_id"), "tweet_id", block, path)
    total = selection.count() * len(slugs)
    waiting = spark.read.parquet(f"{path}/rows").agg(F.coalesce(F.sum(F.size("__slugs")), F.lit(0))).first()[0]
    counts, streak, stopped, began = {"ok": 0, "failed": 0}, 0, False, time.monotonic()
    try:
        for k in range(blocks):
            part = spark.read.parquet(f"{path}/blocks").where(F.col("__block") == k)
            work = part.select("tweet_id", "_payload", "contexto_incompleto", F.explode("__slugs").alias("slug"))
            written = append(score(work, instructions, scorers, rubric_levels, attempts, wait, timeout), k)
            seen = [r.asDict() for r in written.select("tweet_id", "estado").orderBy("tweet_id").toLocalIterator()]  # one block
            good = sum(r["estado"] in RESULT_STATES for r in seen)
            counts = {"ok": counts["ok"] + good, "failed": counts["failed"] + len(seen) - good}
            say(progress(sum(counts.values()), waiting, counts["failed"], time.monotonic() - began))
            stopped, streak = breaker_tripped(seen, streak, limit)
            if stopped:
                break
    finally:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
    return counts | {"reused": total - waiting, "left": waiting - sum(counts.values()), "stopped": stopped}


def run_totals(records: DataFrame, total: int) -> DataFrame:
    """ok, failed and reused pairs of a run that wrote records, out of total pairs."""
    one = records.agg(F.count_if(F.col("estado").isin(*RESULT_STATES)).alias("ok"), F.count_if(~F.col("estado").isin(*RESULT_STATES)).alias("failed"))
    return one.withColumn("reused", F.lit(total).cast("long") - F.col("ok") - F.col("failed"))


def shared_dir(spark) -> str:
    """The folder of spark.checkpoint.dir; a local master without one gets a temporary folder."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tesela-")
    return found.rstrip("/")


def empty_log(spark) -> DataFrame:
    return spark.createDataFrame([], T.StructType([*RECORD.fields, T.StructField("seq", T.LongType())]))
