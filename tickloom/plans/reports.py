"""Reports in Markdown and plain text: rules, parity, health, a day's validation.

Tables in them are aggregates or a few examples a group; nothing else reaches the driver.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import parity, quality
from tickloom.operators.detect import examples

#: Text of a rule in reports, fixed values beside ``quality.DETAIL``.
DESCRIPTIONS = {**quality.DETAIL}
#: Longest text of a table's cell.
WIDEST = 80


def cell(value) -> str:
    """A value as text: four digits of a number, times to the second, long text cut."""
    if value is None:
        return ""
    if isinstance(value, float):
        return f"{value:.4f}"
    if isinstance(value, datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S")
    text = str(value).replace("|", "\\|").replace("\n", " ")
    return text if len(text) <= WIDEST else text[: WIDEST - 3] + "..."


def table(columns: list[str], rows: list) -> str:
    lines = [columns, ["---"] * len(columns), *[[cell(v) for v in r] for r in rows]]
    return "\n".join("| " + " | ".join(line) + " |" for line in lines)


def section(title: str, df: DataFrame) -> str:
    """A heading and the rows of a small frame as a table."""
    rows = df.collect()
    return f"\n## {title}\n\n" + (table(df.columns, rows) if rows else "None.") + "\n"


def grouped(title: str, chosen: DataFrame, by: str, columns: list[str]) -> str:
    """Examples of each group, most frequent group first, with how many more there are (see ``examples``)."""
    rows = chosen.orderBy(F.desc("total"), by, "place").collect()
    parts, done = [f"\n## {title}\n"], []
    for r in rows:
        if r[by] in done:
            continue
        done.append(r[by])
        own = [x for x in rows if x[by] == r[by]]
        parts.append(f"\n### {r[by]}: {r['total']}\n\n" + table(columns, [[x[c] for c in columns] for x in own]))
        if r["total"] > len(own):
            parts.append(f"\n... and {r['total'] - len(own)} more")
    return "\n".join(parts if done else [*parts, "\nNone."]) + "\n"


def rules_report(bars: DataFrame, timeframe_seconds: int, symbols: str, start: str, end: str, timeframe: str, source: str = "bars", most: int = 25) -> str:
    """What the rule pack found: a line a rule with its share, offending rows, the assessment.

    R6 is checked where all quotes are known, other rules on every bar.
    """
    judged = bars if "rules" in bars.columns else quality.flagged(bars, timeframe_seconds)
    total = quality.report_verdict(quality.rule_summary(judged, timeframe_seconds)).first().asDict()
    lines = []
    for name in ("R1", "R2", "R3", "R4", "R5", "R6", "NEG_VOL"):
        n, checked = total[name.lower()], total["r6_checked"] if name == "R6" else total["bars"]
        lines.append([name, DESCRIPTIONS[name], checked, n, f"{100 * n / checked if checked else 0:.2f} %"])
    chosen = examples(quality.violations(judged, timeframe_seconds, None), most, "rule")
    said = {"PASS": "all rules passed", "INVESTIGATE": "the critical rules passed, some spreads are excessive", "FAIL": f"critical violations: {total['r1'] + total['r2'] + total['r3'] + total['r4']}"}[total["verdict"]]
    parts = [
        "# Rule validation\n",
        f"- Symbols: {symbols}\n- Range: {start} to {end}\n- Timeframe: {timeframe}\n- Source: {source}\n- Bars: {total['bars']}\n",
        "\n## Summary\n\n" + table(["rule", "description", "checked", "violations", "share"], lines) + "\n",
        f"\nSpreads: {total['r6_negative']} negative, {total['r6_excessive']} excessive of {total['r6_checked']}.\n",
        grouped("Violations", chosen, "rule", ["symbol", "ts", "severity", "row_sample"]),
        f"\n## Assessment\n\n{total['verdict']}: {said}.\n",
    ]
    return "\n".join(parts)


def parity_report(own: DataFrame, official: DataFrame, start: str, end: str, price_tolerance: float = 0.001, volume_bps: float = 50.0, most: int = 25) -> str:
    """How own bars differ from official ones: a line a symbol, and its first mismatching rows."""
    flags = parity.flag(own, official, price_tolerance, volume_bps)
    chosen = examples(flags.where("mismatch"), most, "symbol", ("ts",))
    parts = [
        "# Parity\n",
        f"- Range: {start} to {end}\n- Tolerance: {price_tolerance} in price, {volume_bps} basis points in volume\n",
        section("Symbols", parity.parity_summary(flags).orderBy("symbol")),
        grouped("Mismatching rows", chosen, "symbol", ["ts", *[f"{p}_{side}" for p in quality.PRICES for side in ("our", "ref")], "max_diff", "volume_bps"]),
    ]
    return "\n".join(parts)


def validation_lines(bars: DataFrame, exchange: str, symbol: str, step_seconds: float = 1.0) -> str:
    """A series' plain text report, ``name: value`` a line: rows, first and last bar, gaps, duplicates, nulls."""
    own = bars.where((F.col("exchange") == exchange) & (F.col("symbol") == symbol))
    one = own.agg(F.count("*").alias("rows"), F.min("ts").alias("first"), F.max("ts").alias("last"), F.count_if(F.col("close").isNull()).alias("null_close")).first()
    gaps = quality.with_gaps(own, step_seconds).where(F.col("gap_seconds") > step_seconds).count()
    distinct = own.select("ts").distinct().count()
    facts = {"exchange": exchange, "symbol": symbol, "rows": one["rows"], "first": cell(one["first"]), "last": cell(one["last"]), "gaps": gaps, "duplicates": one["rows"] - distinct, "null_close": one["null_close"]}
    return "\n".join(f"{k}: {v}" for k, v in facts.items())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, replaced, on any file system that Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
