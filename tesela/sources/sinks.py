"""Artifacts: single CSV files with a byte-order mark, their verification, sidecars and the report page."""

from __future__ import annotations

import csv
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ACCENTS, CJK = "[áéíóúñÁÉÍÓÚÑ]", "[぀-ヿ一-鿿가-힯]"


def write_csv(df: DataFrame, path: str) -> int:
    """A single file with a byte-order mark on the driver, row by row; for artifacts that people open. Returns the rows."""
    n = 0
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(df.columns)
        for row in df.toLocalIterator():
            out.writerow(["" if v is None else v for v in row])
            n += 1
    return n


def write_parts(df: DataFrame, path: str) -> None:
    """The same rows as a folder of CSV parts, written by the executors."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def verify_csv(spark: SparkSession, path: str, text_col: str, rows: int = 200) -> dict:
    """Whether accents and CJK are still readable in the first rows."""
    from .tables import read_table

    head = read_table(spark, path, "UTF-8").limit(rows)
    one = head.agg(F.count("*").alias("rows"), F.count_if(F.col(text_col).rlike(ACCENTS)).alias("accents"), F.count_if(F.col(text_col).rlike(CJK)).alias("cjk")).first()
    return one.asDict()


def sidecar(log_path: str) -> Path:
    return Path(str(log_path).rstrip("/") + ".rubrica")


def record_fingerprint(log_path: str, fingerprint: str) -> None:
    sidecar(log_path).write_text(fingerprint, encoding="utf-8")


def recorded_fingerprint(log_path: str) -> str | None:
    path = sidecar(log_path)
    return path.read_text(encoding="utf-8").strip() if path.exists() else None


PAGE = """<!DOCTYPE html>
<html lang="es"><head><meta charset="utf-8"><title>__TITLE__</title>
<style>body{font:14px sans-serif;margin:2em}svg{border:1px solid #ddd;display:block;margin:4px 0 18px}label{margin-right:1em}table{border-collapse:collapse;margin-bottom:18px}td,th{border:1px solid #ccc;padding:2px 8px}</style></head>
<body><h1>__TITLE__</h1><form id="controls"></form><div id="charts"></div><div id="tables"></div>
<script>
const data = __DATA__, WIDTH = 900, HEIGHT = 220, EDGE = 30;
const COLOURS = ["#4e79a7", "#f28e2b", "#59a14f", "#e15759", "#b07aa1", "#76b7b2", "#9c755f", "#edc948"];
const make = (tag, attrs, ...kids) => { const e = document.createElementNS("http://www.w3.org/2000/svg", tag); for (const k in attrs) e.setAttribute(k, attrs[k]); e.append(...kids); return e; };
const html = (tag, text, ...kids) => { const e = document.createElement(tag); if (text) e.textContent = text; e.append(...kids); return e; };
const unique = key => [...new Set(data.cube.map(r => r[key]))].sort();
const days = unique("fecha"), chosen = new Set(unique("idioma"));
const state = { alone: false, smooth: true, shares: true };
const x = i => EDGE + (i + 0.5) * (WIDTH - 2 * EDGE) / Math.max(days.length, 1), y = share => HEIGHT - EDGE - share * (HEIGHT - 2 * EDGE);
function control(text, checked, act) {
  const box = document.createElement("input"); box.type = "checkbox"; box.checked = checked;
  box.onchange = () => { act(box.checked); draw(); };
  document.getElementById("controls").append(html("label", "", box, text));
}
// Totals of a criterion by day: of each level, of valence, of absence. A day without any record has no entry.
function tally(criterion) {
  const byDay = new Map();
  for (const r of data.cube) {
    if (r.slug !== criterion.slug || !chosen.has(r.idioma) || (state.alone && !r.autosuficiente)) continue;
    if (!byDay.has(r.fecha)) byDay.set(r.fecha, { level: {}, valence: 0, absence: 0 });
    const day = byDay.get(r.fecha);
    if (r.clase === "valencia" && criterion.levels.includes(r.nivel)) { day.level[r.nivel] = (day.level[r.nivel] || 0) + r.n; day.valence += r.n; }
    else if (r.clase === "ausencia") day.absence += r.n;
  }
  return days.map(d => byDay.get(d) || null);
}
function smoothed(values) {
  if (!state.smooth) return values;
  const half = data.window >> 1;
  return values.map((_, i) => { const near = values.slice(Math.max(0, i - half), i + half + 1).filter(v => v !== null); return near.length ? near.reduce((a, v) => a + v) / near.length : null; });
}
function frame(title, names) {
  const svg = make("svg", { width: WIDTH, height: HEIGHT }), legend = html("p", "");
  names.forEach((n, i) => { const s = html("span", "\u25A0 " + n + "  "); s.style.color = COLOURS[i % COLOURS.length]; legend.append(s); });
  for (const p of data.periods) { const from = days.findIndex(d => d >= p.start); if (from > 0) svg.append(make("line", { x1: x(from - 0.5), x2: x(from - 0.5), y1: EDGE, y2: HEIGHT - EDGE, stroke: "#bbb" })); }
  if (days.length) for (const [i, anchor] of [[0, "start"], [days.length - 1, "end"]]) svg.append(make("text", { x: x(i), y: HEIGHT - 8, "text-anchor": anchor, "font-size": 11 }, days[i]));
  document.getElementById("charts").append(html("h2", title), legend, svg);
  return svg;
}
function draw() {
  document.getElementById("charts").replaceChildren();
  const svg = frame("Saliencia", data.criteria.map(c => c.name));
  data.criteria.forEach((c, i) => {
    const line = smoothed(tally(c).map(d => d && d.valence + d.absence ? d.valence / (d.valence + d.absence) : null));
    let path = "", open = false;
    line.forEach((v, j) => { if (v !== null) path += (open ? "L" : "M") + x(j) + " " + y(v); open = v !== null; });
    svg.append(make("path", { d: path || "M0 0", fill: "none", stroke: COLOURS[i % COLOURS.length], "stroke-width": 2 }));
    line.forEach((v, j) => { if (v !== null) svg.append(make("circle", { cx: x(j), cy: y(v), r: 2.5, fill: COLOURS[i % COLOURS.length] }, make("title", {}, days[j] + ": " + (100 * v).toFixed(1) + " %"))); });
  });
  for (const c of data.criteria) {
    const bars = frame(c.name, c.levels), found = tally(c), most = Math.max(1, ...found.map(d => d ? d.valence : 0)), wide = 0.8 * (WIDTH - 2 * EDGE) / Math.max(days.length, 1);
    found.forEach((d, j) => { let base = 0; if (d && d.valence) c.levels.forEach((n, i) => {
      const part = (d.level[n] || 0) / (state.shares ? d.valence : most);
      bars.append(make("rect", { x: x(j) - wide / 2, y: y(base + part), width: wide, height: y(base) - y(base + part), fill: COLOURS[i % COLOURS.length] }, make("title", {}, days[j] + ", " + n + ": " + (d.level[n] || 0))));
      base += part; }); });
  }
}
for (const l of unique("idioma")) control(l, true, on => on ? chosen.add(l) : chosen.delete(l));
control("sólo autosuficientes", false, on => { state.alone = on; });
control("suavizar", true, on => { state.smooth = on; });
control("proporciones", true, on => { state.shares = on; });
draw();
for (const [name, rows] of Object.entries(data.tables)) {
  if (!rows.length) continue;
  const keys = Object.keys(rows[0]), line = (cells, tag) => html("tr", "", ...cells.map(v => html(tag, String(v))));
  document.getElementById("tables").append(html("h2", name), html("table", "", line(keys, "th"), ...rows.map(r => line(keys.map(k => r[k]), "td"))));
}
</script></body></html>"""


def page(title: str, cube: DataFrame | list, criteria: list[dict], periods: list[dict], tables: dict[str, DataFrame | list], window: int = 7) -> str:
    """A page that needs nothing else: the salience of each criterion and its levels by day, with controls for languages, self-sufficient
    tweets, smoothing and shares, and tables. criteria: slug, name, levels. The cube has days times criteria, levels and languages, and is
    small at any input."""
    rows = lambda v: [r.asDict() for r in v.collect()] if isinstance(v, DataFrame) else v
    data = {"cube": rows(cube), "criteria": criteria, "periods": periods, "window": window, "tables": {k: rows(v) for k, v in tables.items()}}
    text = json.dumps(data, ensure_ascii=False, default=str).replace("</", "<\\/")
    return PAGE.replace("__TITLE__", title.replace("&", "&amp;").replace("<", "&lt;")).replace("__DATA__", text)
