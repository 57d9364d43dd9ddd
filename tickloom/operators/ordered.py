"""Work on rows in time order, without one sort for each whole series.

A series is cut into days or blocks, each a task's work at most; what crosses an edge is
one row a day, or the moments of a part of a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def series_keys(df: DataFrame) -> list[str]:
    """What tells one series of bars from another: exchange and symbol, as far as there are such columns."""
    return [c for c in ("exchange", "symbol") if c in df.columns]


def named(by: list[str] | tuple[str, ...]) -> Column:
    """A series' keys in one value, to join by: such values are equal where the same keys are null, so a series without a symbol stays."""
    return F.struct(*by)


def micros(ts: str) -> Column:
    """Microseconds since 1970 of a time with or without zone."""
    return F.unix_micros(F.col(ts).cast("timestamp"))


def day_of(ts: str) -> Column:
    """The day of a time; rows without a time come after all days."""
    return F.coalesce(F.to_date(ts), F.lit("9999-12-31").cast("date"))


def with_neighbour(df: DataFrame, by: list[str] | tuple[str, ...], columns: list[str], ts: str = "ts", after: bool = False) -> DataFrame:
    """Add ``prev_`` (or ``next_``) columns of the neighbouring row of the same key in time.

    Rows are ordered inside (key, day), so a symbol of many years is as many tasks as days;
    the neighbour of a day's outer row comes from one row for each day, found in the same
    order.  Equal times are ordered by the columns asked for; rows without a time come last.
    """
    keys = ["__series", "__day"]
    here = F.struct(*columns)
    inside = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(ts), *[c for c in columns if c != ts])
    across = Window.partitionBy("__series").orderBy("__day")
    step, back = (F.lead, F.lag) if after else (F.lag, F.lead)
    rows = df.withColumns({"__series": named(by), "__day": day_of(ts)}).withColumns({"__inner": step(here).over(inside), "__outermost": back(F.lit(True)).over(inside).isNull()})
    edge = rows.where("__outermost").select(*keys, here.alias("__edge"))  # one row a day; it reuses the exchange of the rows
    outer = edge.select(*keys, step("__edge").over(across).alias("__outer"))
    both = rows.join(outer, keys, "left")
    near = F.coalesce("__inner", "__outer")
    name = "next_" if after else "prev_"
    return both.withColumns({f"{name}{c}": near[c] for c in columns}).drop(*keys, "__inner", "__outer", "__outermost")


def with_carried(df: DataFrame, by: list[str], column: str, name: str, ts: str = "ts") -> DataFrame:
    """Add ``name``: the last known value of ``column`` up to the row, carried on inside days and from day to day."""
    keys = [*by, "__day"]
    order = Window.partitionBy(*keys).orderBy(ts)
    across = Window.partitionBy(*by).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("__day", F.to_date(ts)).withColumns(
        {"__seen": F.last(column, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "__outermost": F.lead(F.lit(True)).over(order).isNull()}
    )
    days = rows.where("__outermost").select(*keys, F.last("__seen", ignorenulls=True).over(across).alias("__before"))
    return rows.join(days, keys, "left").withColumn(name, F.coalesce("__seen", "__before")).drop("__day", "__seen", "__outermost", "__before")


def with_position(df: DataFrame, by: list[str], ties: list[str], ts: str = "ts") -> DataFrame:
    """Add ``position`` from 0 in the order of (ts, ties) and ``rows_of_series``, ordered inside days; rows without a time come last."""
    keys = ["__series", "__day"]
    rows = df.withColumns({"__series": named(by), "__day": day_of(ts)})
    inside = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(ts), *ties)
    before = Window.partitionBy("__series").orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    days = rows.groupBy(*keys).agg(F.count("*").alias("__n"))
    days = days.select(*keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy("__series")).alias("rows_of_series"))  # a row a day
    placed = rows.withColumn("__inside", F.row_number().over(inside)).join(days, keys)
    return placed.withColumn("position", F.col("__before") + F.col("__inside") - 1).drop(*keys, "__inside", "__before")


def _moments(value: Column, over) -> Column:
    """Count, mean and sum of squared deviations of a column's known values in a frame."""
    n, spread = F.count(value).over(over), F.var_pop(value).over(over)
    return F.struct(n.alias("n"), F.coalesce(F.avg(value).over(over), F.lit(0.0)).alias("mean"), F.coalesce(spread * n, F.lit(0.0)).alias("m2"))


def merged(a: Column, b: Column) -> Column:
    """Moments of two sets of values taken together; no difference of large sums is taken."""
    n = a["n"] + b["n"]
    apart, share = b["mean"] - a["mean"], b["n"] / F.nullif(n, F.lit(0))
    mean = F.coalesce(a["mean"] + apart * share, F.lit(0.0))
    return F.struct(n.alias("n"), mean.alias("mean"), (a["m2"] + b["m2"] + F.coalesce(apart * apart * a["n"] * share, F.lit(0.0))).alias("m2"))


def trailing_moments(df: DataFrame, by: list[str], at: str, length: int, columns: list[str]) -> DataFrame:
    """Add for each of ``columns`` the moments of its known values in the frame (at - length, at], as a struct of its name and ``_moments``.

    ``at`` is a whole number that orders a series: a position, or a time in microseconds; rows
    with equal ``at`` see each other.  A series is cut into blocks of ``length``, so a frame is
    the beginning of a row's own block and the end of the block before: two running moments,
    merged.  Every row is dealt once by its own block, and once to the block where its frame
    begins, so the work of a row does not grow with the frame, and no window is longer than
    a block.
    """
    own = F.floor(F.col(at) / length)
    block = [*by, "__block"]
    up = Window.partitionBy(*block).orderBy(at).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*block).orderBy(F.desc("__at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    begun = df.withColumn("__block", own).withColumns({f"__up_{c}": _moments(F.col(c), up) for c in columns})
    # as a value the row belongs to its own block, as a question to the one where its frame begins
    values = begun.select(*by, "__block", F.col(at).alias("__at"), F.lit(None).cast(begun.select(F.struct(*begun.columns)).schema[0].dataType).alias("__row"), *[F.col(c).alias(f"__value_{c}") for c in columns])
    asked = begun.select(*by, (F.col("__block") - 1).alias("__block"), (F.col(at) - length + 1).alias("__at"), F.struct(*begun.columns).alias("__row"), *[F.lit(None).cast(begun.schema[c].dataType).alias(f"__value_{c}") for c in columns])
    seen = values.unionByName(asked).withColumns({f"__down_{c}": _moments(F.col(f"__value_{c}"), down) for c in columns}).where(F.col("__row").isNotNull())
    nothing = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    whole = (F.col("__at") >= (F.col("__block") + 1) * length)  # the frame begins with the row's own block
    both = {c: merged(F.when(whole, nothing).otherwise(F.col(f"__down_{c}")), F.col("__row")[f"__up_{c}"]) for c in columns}
    return seen.select(*[F.col("__row")[c].alias(c) for c in df.columns], *[m.alias(f"{c}_moments") for c, m in both.items()])


def as_of(left: DataFrame, right: DataFrame, by: list[str], columns: list[str], ts: str = "ts", strict: bool = False) -> DataFrame:
    """Left rows with ``columns`` of the last right row of their key at or before their time (before it, if ``strict``).

    Both sides are united and ordered inside (key, day), where the last right row is carried
    on; a day begins with the last one of the days before, from one row a day.  No left row
    is lost; of right rows with equal key and time one should stay.
    """
    keys = [*by, "__day"]
    here = F.struct(*columns)
    ours = left.select(F.struct(*left.columns).alias("__left"), *by, F.col(ts).alias("__ts"), F.lit(0 if strict else 1).alias("__side"), F.lit(None).cast(right.select(here).schema[0].dataType).alias("__right"))
    theirs = right.select(F.lit(None).cast(ours.schema["__left"].dataType).alias("__left"), *by, F.col(ts).alias("__ts"), F.lit(1 if strict else 0).alias("__side"), here.alias("__right"))
    both = ours.unionByName(theirs).withColumn("__day", F.to_date("__ts"))
    inside = Window.partitionBy(*keys).orderBy("__ts", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    across = Window.partitionBy(*by).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    in_order = Window.partitionBy(*keys).orderBy("__ts", "__side")
    carried = both.withColumns({"__seen": F.last("__right", ignorenulls=True).over(inside), "__outermost": F.lead(F.lit(True)).over(in_order).isNull()})
    days = carried.where("__outermost").select(*keys, F.last("__seen", ignorenulls=True).over(across).alias("__before"))
    rows = carried.where(F.col("__left").isNotNull()).join(days, keys, "left")
    found = F.coalesce("__seen", "__before")
    return rows.select(*[F.col("__left")[c].alias(c) for c in left.columns], *[found[c].alias(c) for c in columns])
