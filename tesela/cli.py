"""The stages on the command line. Exit codes: 0 done, 1 stopped or not confirmed, 2 a wrong call or input, 130 interrupted."""

from __future__ import annotations

import argparse
import functools
import importlib
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators import export, keys, log, repair, rubric, scoring, select, temporal, translate
from .schema import TRANSLATION
from .sources import config, logs, sinks, tables


def _rubric(cfg: config.Config) -> dict:
    return rubric.load(cfg.rubric)


def _log(spark: SparkSession, cfg: config.Config) -> DataFrame:
    return logs.read_log(spark, tables.require(spark, cfg.log, "the score log", "correr"))


def _corpus(spark: SparkSession, cfg: config.Config) -> DataFrame:
    return tables.read_corpus(spark, cfg.corpus_to_score(), (cfg.col_id, cfg.col_text))[0]


def _write(df: DataFrame, path: str, args: argparse.Namespace) -> None:
    """A single file for people, or with --partes a folder that the executors write."""
    (sinks.write_parts if args.partes else sinks.write_csv)(df, path)


def _function(name: str) -> Callable:
    module, _, attr = name.partition(":")
    return getattr(importlib.import_module(module), attr)


def stage_repair(spark, cfg, args) -> int:
    if Path(cfg.repaired).exists() and not args.forzar:
        rows = [tables.read_source(spark, cfg.corpus).count(), tables.read_table(spark, cfg.repaired).count()]
        print(f"{cfg.repaired} is there already with {rows[1]} rows of {rows[0]}; --forzar makes it again")
        return int(rows[0] != rows[1])
    source = tables.read_source(spark, cfg.corpus)
    fixed = repair.repair(source)
    _write(fixed, cfg.repaired, args)
    if repeated := keys.collisions(fixed, cfg.col_id).count():
        print(f"{repeated} ids repeat")
    return 0


def stage_consolidate(spark, cfg, args) -> int:
    base, extra = [keys.resolved(tables.read_table(spark, p)).drop("key_source") for p in (args.base, args.extra)]
    only = keys.column_differences(base, extra)
    print(f"columns only in the base: {only[0]}; only in the extra rows: {only[1]}")
    _write(keys.consolidate(base, extra, cfg.col_id), args.destino, args)
    return 0


def stage_translate(spark, cfg, args) -> int:
    """Translates what is pending when confirmed and a translator is given, then merges the log into the corpus."""
    there = lambda: Path(cfg.translation_log).exists()
    read = lambda: logs.read_log(spark, cfg.translation_log, TRANSLATION, ("tweet_id",)) if there() else spark.createDataFrame([], T.StructType([*TRANSLATION.fields, T.StructField("seq", T.LongType())]))
    corpus = tables.read_corpus(spark, cfg.repaired or cfg.corpus, (cfg.col_id, cfg.col_text))[0]
    cols = {"id_col": cfg.col_id, "text_col": cfg.col_text, "translation_col": cfg.col_translation}
    waiting = translate.targets(corpus, read(), cfg.again, **cols)
    n = waiting.agg(F.count("*").alias("rows"), F.count_if("retry").alias("retries")).first()
    print(f"{n['rows']} rows to translate, {n['retries']} of them again; about {translate.cost(n['rows'], '', *cfg.prices.get(cfg.model, [0.0, 0.0])):.2f}")
    if n["rows"] and args.confirmar and args.traductor:
        append = lambda records: logs.append_log(records, cfg.translation_log, logs.next_block(read()))
        calls = {"calls": cfg.translation_calls, "attempts": cfg.attempts, "timeout": cfg.call_timeout, "wait": functools.partial(scoring.backoff, most=cfg.most_wait)}
        translate.translate_corpus(corpus, _function(args.traductor), read, append, cfg.again, **cols, **calls)
    elif not there():
        print("nothing was translated; --confirmar and --traductor module:function translate")
        return 1
    _write(translate.merged(corpus, read(), again=cfg.again, **cols), cfg.translated, args)
    translate.fill_report(corpus, read(), again=cfg.again, **cols).show()
    return 0


def stage_rubric(spark, cfg, args) -> int:
    r = _rubric(cfg)
    rubric.levels(spark, r).show(100, False)
    print(f"fingerprint {rubric.fingerprint(r)}; anchoring {rubric.anchoring(r, cfg.anchors)}")
    return 0


def stage_run(spark, cfg, args) -> int:
    """Estimates always; scores only when confirmed and a scorer is given."""
    r = _rubric(cfg)
    texts = {c["slug"]: rubric.instruction(c, cfg.most_words) for c in r["criterios"]}
    chosen = select.select(_corpus(spark, cfg), langs=cfg.langs, query_types=cfg.query_types, drop_retweets=cfg.drop_retweets, drop_quotes=cfg.drop_quotes, text_col=cfg.col_text, lang_col=cfg.col_lang)
    rows = select.payload(select.sample(chosen, cfg.sample, cfg.seed, cfg.col_id), cfg.col_text, cfg.col_lang, cfg.col_translation)
    price = cfg.prices.get(cfg.model, [0.0, 0.0])
    scoring.cost(rows, list(texts.values()), *price, most_words=cfg.most_words, reasoning=cfg.reasoning).show()
    if not args.confirmar or not args.scorer:
        print("nothing was scored; --confirmar and --scorer module:function score")
        return 1
    scorer, levels, wait = _function(args.scorer), rubric.levels(spark, r), functools.partial(scoring.backoff, most=cfg.most_wait)
    read = lambda: logs.read_log(spark, cfg.log) if Path(cfg.log).exists() else scoring.empty_log(spark)
    log.check_correspondence(read(), list(texts), rubric.fingerprint(r), sinks.recorded_fingerprint(cfg.log), args.forzar)
    if not rubric.isolated(list(texts.values()), r):
        raise ValueError("the prompt of a criterion holds another's descriptor")
    if args.prueba:
        scoring.smoke(rows, levels, texts, [scorer], timeout=cfg.call_timeout, id_col=cfg.col_id).show(100, False)
        return 0
    first = logs.next_block(read())

    def append(records: DataFrame, k: int) -> DataFrame:
        logs.append_log(records, cfg.log, first + k)
        return logs.appended(spark, cfg.log, first + k)

    flight = scoring.rows_in_flight(cfg.calls, len(texts))
    got = scoring.run(rows.repartition(flight), levels, texts, [scorer], read, append, cfg.scope, cfg.block, cfg.breaker, cfg.attempts, cfg.col_id, wait=wait, timeout=cfg.call_timeout, say=print)
    sinks.record_fingerprint(cfg.log, rubric.fingerprint(r))
    print(got)
    return int(got["stopped"])


def stage_audit(spark, cfg, args) -> int:
    records = _log(spark, cfg)
    log.audit(records, logs.unreadable(spark, cfg.log)).show()
    log.state_histogram(records).show()
    log.top_failures(records).show(5, False)
    log.slug_difference(records, rubric.slugs(_rubric(cfg))).show()
    return 0


def stage_export(spark, cfg, args) -> int:
    r, corpus = _rubric(cfg), _corpus(spark, cfg)
    resolved = log.resolve(_log(spark, cfg))
    numeric = [c["slug"] for c in r["criterios"] if c["escala_numerica"]]
    _write(export.wide(resolved, corpus, rubric.slugs(r), numeric, cfg.col_id), f"{cfg.output}/ancho.csv", args)
    _write(export.tidy(resolved, corpus, rubric.criteria(spark, r), cfg.col_id), f"{cfg.output}/tidy.csv", args)
    print(sinks.verify_csv(spark, f"{cfg.output}/ancho.csv", cfg.col_text))
    return 0


def _ratings(spark: SparkSession, cfg: config.Config) -> DataFrame:
    """The tidy export if it is there, else the resolved log."""
    if Path(cfg.output, "tidy.csv").exists():
        return tables.read_table(spark, f"{cfg.output}/tidy.csv")
    return log.resolve(_log(spark, cfg))


def stage_charts(spark, cfg, args) -> int:
    r, corpus, ratings = _rubric(cfg), _corpus(spark, cfg), _ratings(spark, cfg)
    ready = temporal.prepare(ratings, corpus, cfg.col_time, cfg.zone, cfg.periods, cfg.col_id, cfg.col_lang).cache()
    temporal.prepare_report(ready, ratings, corpus, cfg.coverage, cfg.col_id).show(1, False, True)
    cube = temporal.cube(ready, {k: sorted(v) for k, v in rubric.absence_levels(r, cfg.absence).items()}).cache()
    shown = {"volumen": temporal.volume(ready), "idiomas": temporal.languages(ready), "periodos": temporal.by_period(ready, cfg.periods), "clases": temporal.class_totals(cube)}
    criteria = [{"slug": c["slug"], "name": rubric.short_name(c), "levels": [str(x) for x in c["etiquetas_validas"]]} for c in r["criterios"]]
    page = sinks.page(cfg.name, cube, criteria, [{"name": p.name, "start": p.start} for p in cfg.periods], shown, cfg.smoothing)
    Path(cfg.output, "graficas.html").write_text(page, encoding="utf-8")
    return 0


STAGES: dict[str, Callable] = {"reparar": stage_repair, "consolidar": stage_consolidate, "traducir": stage_translate, "rubrica": stage_rubric, "correr": stage_run, "auditar": stage_audit, "exportar": stage_export, "graficar": stage_charts}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tesela")
    p.add_argument("etapa", choices=STAGES)
    p.add_argument("--perfil", required=True)
    p.add_argument("--config", default="config.toml")
    p.add_argument("--confirmar", action="store_true")
    p.add_argument("--forzar", action="store_true")
    p.add_argument("--prueba", action="store_true", help="score one row and log nothing")
    p.add_argument("--partes", action="store_true", help="write folders of CSV parts")
    p.add_argument("--scorer", help="module:function")
    p.add_argument("--traductor", help="module:function")
    for x in ("base", "extra", "destino"):
        p.add_argument(f"--{x}")
    return p


def main(argv: list[str] | None = None) -> int:
    for s in (sys.stdout, sys.stderr):
        if hasattr(s, "reconfigure"):
            s.reconfigure(encoding="utf-8", line_buffering=True)
    try:
        args = parser().parse_args(argv)
    except SystemExit as e:
        return int(e.code or 0)
    try:
        cfg = config.load(args.config, args.perfil)
        spark = SparkSession.builder.appName("tesela").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        return STAGES[args.etapa](spark, cfg, args)
    except (config.ConfigError, FileNotFoundError, ValueError, AnalysisException) as e:
        print(e, file=sys.stderr)
        return 2
    except KeyboardInterrupt:
        return 130


if __name__ == "__main__":
    sys.exit(main())
