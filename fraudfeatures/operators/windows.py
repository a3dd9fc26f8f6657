"""Rolling windows over the seconds before each row.

A window of N seconds at a row of second t holds the rows of the same key with seconds from t - N to t - 1: the row itself and
others of its second are left out. Two engines compute the same numbers, both by differences of running totals, so that the
length of a window costs nothing. The engine `range` exchanges rows once, by key, and sorts each key in one task: a window is the total
up to t - 1 less the total up to t - N - 1. The engine `sweep` is for keys that hold more rows than a task should sort: it writes each row
as a change when it enters and leaves each window, adds the changes up in order of time within spans of a few hours, and carries
the totals from span to span. It writes its input and the changes to the shared folder, reads the input once, and adds exact numbers
only, so that differences are exact: sums of doubles are refused (cast them to decimals).

A value counts once in a window: it enters with an occurrence that none precedes by N seconds or less, and leaves N seconds
after one that none follows so closely.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudfeatures.sources.work import fresh, stored

UNITS = {"MINUTE": 60, "HOUR": 3600, "DAY": 86400}
KINDS = ("count", "sum", "avg", "distinct")
SPAN = 6 * 3600  # seconds of a key that a sweep adds up in one piece


def seconds(unit: str, n: int) -> int:
    """N units in seconds; MINUTE, HOUR and DAY are known."""
    if unit not in UNITS:
        raise ValueError(f"unit {unit!r} is none of {', '.join(UNITS)}")
    return n * UNITS[unit]


@dataclass(frozen=True)
class Rolling:
    """A column `name`: a count of rows (where `value`, if given, is true), the sum or average of `value`, or its number of
    distinct values, over `seconds` before each row. Empty windows give 0."""

    name: str
    kind: str
    seconds: int
    value: Column | str | None = None

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"kind {self.kind!r} is none of {', '.join(KINDS)}")


def epoch(ts: Column | str) -> Column:
    return F.unix_timestamp(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


def rolling(df: DataFrame, key: str, columns: list[Rolling], ts: str = "event_timestamp", engine: str = "range") -> DataFrame:
    """df with these columns more. engine: range, or sweep where single keys hold very many rows."""
    if engine not in ENGINES:
        raise ValueError(f"engine {engine!r} is none of {', '.join(ENGINES)}")
    if engine == "range":
        return _ranges(df, key, columns, ts)
    row = fresh(df, "sweep_row")
    df = stored(df.withColumn(row, F.monotonically_increasing_id()), "swept")
    return df.join(_sweep(df, row, key, columns, ts), row).drop(row)


def windows_of(df: DataFrame, row: str, key: str, columns: list[Rolling], ts: str = "event_timestamp", engine: str = "range") -> DataFrame:
    """The columns alone, by a column `row` that numbers the rows of df; rows in which it is null take part and have no result. The sweep
    reads df several times: it should be a written table."""
    if engine not in ENGINES:
        raise ValueError(f"engine {engine!r} is none of {', '.join(ENGINES)}")
    if engine == "sweep":
        return _sweep(df, row, key, columns, ts)
    return _ranges(df, key, columns, ts).where(F.col(row).isNotNull()).select(row, *(c.name for c in columns))


def _ranges(df: DataFrame, key: str, columns: list[Rolling], ts: str) -> DataFrame:
    second = fresh(df, "rolling_second")
    at = Window.partitionBy(key).orderBy(second)
    upto = lambda back: at.rangeBetween(Window.unboundedPreceding, -back)
    # Dealt by key, rows of a key and value are together as well, so that no window exchanges them again.
    out, base = {}, df.withColumn(second, epoch(ts)).repartition(key)
    values = {i: F.col(c.value) if isinstance(c.value, str) else c.value for i, c in enumerate(columns) if c.value is not None}
    kinds = dict(df.select(*(v.alias(str(i)) for i, v in values.items())).dtypes) if values else {}
    gaps: dict[str, tuple[str, str]] = {}
    for i, c in enumerate(columns):
        if c.kind == "distinct" and str(c.value) not in gaps:
            names = gaps[str(c.value)] = (fresh(df, f"rolling_before_{i}"), fresh(df, f"rolling_after_{i}"))
            near = Window.partitionBy(key, values[i]).orderBy(second)
            base = base.withColumns({names[0]: F.col(second) - F.lag(second).over(near), names[1]: F.lead(second).over(near) - F.col(second)})
    for i, c in enumerate(columns):
        value = values.get(i)
        less = lambda agg, n=c.seconds: F.coalesce(agg.over(upto(1)), F.lit(0)) - F.coalesce(agg.over(upto(n + 1)), F.lit(0))
        if c.kind == "count":
            out[c.name] = less(F.count("*" if value is None else F.when(value, True)))
        elif c.kind == "distinct":
            before, after = gaps[str(c.value)]
            far = lambda gap, v=value, n=c.seconds: F.when(v.isNotNull() & F.coalesce(F.col(gap) > n, F.lit(True)), True)
            entered, left = F.count(far(before)).over(upto(1)), F.count(far(after)).over(upto(c.seconds + 1))
            out[c.name] = F.coalesce(entered, F.lit(0)) - F.coalesce(left, F.lit(0))
        else:
            # Differences of floating totals would carry their rounding along.
            exact = kinds[str(i)] not in INEXACT
            frame = at.rangeBetween(-c.seconds, -1)
            total = (less(F.sum(value)) if exact else F.coalesce(F.sum(value).over(frame), F.lit(0))).cast("double")
            n = less(F.count(value))
            out[c.name] = total if c.kind == "sum" else F.when(n > 0, total / n).otherwise(0.0)
    return base.withColumns(out).drop(second, *(name for names in gaps.values() for name in names))


INEXACT = ("double", "float")


def _sweep(df: DataFrame, row: str, key: str, columns: list[Rolling], ts: str) -> DataFrame:
    """(row, the columns) for each row that has a number."""
    at, end = "sweep_at", "sweep_end"
    base = df.select(F.col(row).alias("sweep_row"), F.col(key).alias("sweep_key"), epoch(ts).alias("sweep_second"), *_values(columns))
    kinds = dict(base.dtypes)
    for i, c in enumerate(columns):
        if c.kind in ("sum", "avg") and kinds[f"sweep_value_{i}"] in INEXACT:
            raise ValueError(f"{c.name}: a sweep adds exact numbers only; cast {c.value} to a decimal")
    ends = sorted({c.seconds for c in columns if c.kind != "distinct"})
    # What a row adds to each column's running totals.
    parts = {}
    for i, c in enumerate(columns):
        if c.kind == "distinct":
            continue
        value = F.col(f"sweep_value_{i}")
        if c.kind == "count":
            parts[f"sweep_n_{i}"] = (F.lit(1) if c.value is None else F.when(value, 1).otherwise(0)).cast("bigint"), c.seconds
        else:
            parts[f"sweep_sum_{i}"] = F.coalesce(value, F.lit(0)), c.seconds
            if c.kind == "avg":
                parts[f"sweep_n_{i}"] = F.when(value.isNotNull(), 1).otherwise(0).cast("bigint"), c.seconds
    # The row itself as a probe, at its second; then it enters, for every window, and leaves each at its end.
    # A second's probes see what has entered by its beginning.
    moves = F.array(*(F.struct(F.lit(e).alias(end), (F.col("sweep_second") + (e + 1)).alias(at)) for e in ([-1, 0, *ends] if parts else [-1])))
    probe = F.col(end) == -1
    both = base.select("*", F.inline(moves)).select(
        "sweep_key", at, F.when(probe, F.col("sweep_row")).alias("sweep_row"),
        *(F.when(F.col(end) == 0, v).when(F.col(end) == e, -v).alias(name) for name, (v, e) in parts.items()),
    )
    by_value: dict[str, list[int]] = {}
    for i, c in enumerate(columns):
        if c.kind == "distinct":
            by_value.setdefault(str(c.value), []).append(i)
    for numbers in by_value.values():
        seen = base.select("sweep_key", "sweep_second", F.col(f"sweep_value_{numbers[0]}").alias("v")).where("v IS NOT NULL").distinct()
        following = F.lead("sweep_second").over(Window.partitionBy("sweep_key", "v").orderBy("sweep_second"))
        seen, changes = seen.withColumn("following", following), []
        for i in numbers:
            leaves = F.least(F.col("sweep_second") + columns[i].seconds, F.col("following")) + 1
            changes += [F.struct(when.alias(at), *(F.lit(n if i == j else None).cast("bigint").alias(f"sweep_d_{j}") for j in numbers)) for when, n in ((F.col("sweep_second") + 1, 1), (leaves, -1))]
        both = both.unionByName(seen.select("sweep_key", F.inline(F.array(*changes))), allowMissingColumns=True)
    totals = [c for c in both.columns if c not in ("sweep_key", "sweep_row", at)]
    both = stored(both.withColumn("sweep_span", F.floor(F.col(at) / SPAN)), "changes")

    spans = both.groupBy("sweep_key", "sweep_span").agg(*(F.sum(c).alias(c) for c in totals))
    before = Window.partitionBy("sweep_key").orderBy("sweep_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("sweep_key", "sweep_span", *(F.sum(c).over(before).alias(f"{c}_before") for c in totals))
    within = Window.partitionBy("sweep_key", "sweep_span").orderBy(at)
    found = both.select("sweep_key", "sweep_span", "sweep_row", *(F.sum(c).over(within).alias(c) for c in totals)).where("sweep_row IS NOT NULL")
    same = [F.col("x.sweep_key").eqNullSafe(F.col("y.sweep_key")), F.col("x.sweep_span").eqNullSafe(F.col("y.sweep_span"))]
    found = found.alias("x").join(carried.alias("y"), same[0] & same[1], "left")
    total = lambda c: F.coalesce(c, F.lit(0)) + F.coalesce(f"{c}_before", F.lit(0))
    out = {}
    for i, c in enumerate(columns):
        if c.kind == "distinct":
            out[c.name] = total(f"sweep_d_{i}").cast("bigint")
        elif c.kind == "count":
            out[c.name] = total(f"sweep_n_{i}").cast("bigint")
        elif c.kind == "sum":
            out[c.name] = total(f"sweep_sum_{i}").cast("double")
        else:
            n = total(f"sweep_n_{i}")
            out[c.name] = F.when(n > 0, total(f"sweep_sum_{i}").cast("double") / n).otherwise(0.0)
    return found.select(F.col("sweep_row").alias(row), *(v.alias(k) for k, v in out.items()))


ENGINES = ("range", "sweep")


def _values(columns: list[Rolling]) -> list[Column]:
    return [(F.col(c.value) if isinstance(c.value, str) else c.value).alias(f"sweep_value_{i}") for i, c in enumerate(columns) if c.value is not None]


def parse_window(text: str) -> int:
    """`5m`, `1h` or `30d` in seconds."""
    units = {"m": "MINUTE", "h": "HOUR", "d": "DAY"}
    if text[-1:] not in units or not text[:-1].isdigit():
        raise ValueError(f"window {text!r} is not a number of m, h or d")
    return seconds(units[text[-1]], int(text[:-1]))
