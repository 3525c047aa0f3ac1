"""Exact NTILE by cut points: no sort of the rows, no task that sees a whole group.

NTILE(k) over (key, tie) needs k - 1 boundary tuples a group: the last row of each tile but
the highest. With them a row's tile is a comparison, made where the row is. They are found by
narrowing, each step an aggregate that combines map-side and brings a few rows a group to
the driver (groups are snapshot dates or score names: bounded by the calendar):

1. per group, the number of rows and a bounded summary of the keys (`percentile_approx`, rank
   error n / ACCURACY), read a little before and after each wanted position: a bracket;
2. exact counts: of each distinct key inside a bracket, and one count for all keys between
   two brackets. Running sums give the key at each position, and the position among its ties;
3. where that isn't the last tie, the same among the rows that tie at that key, by a number
   made of the leading bytes in which the group's ties differ; the ties inside the bracket are
   counted one by one.

The boundaries go back to all rows by a broadcast, so the result has the rows' own
partitioning. Steps 2 and 3 hold a fraction SLACK of a group for each boundary, and the ties
that share six bytes with the boundary. Groups of fewer than SMALL rows are one bracket. The
steps run when the function is called, two to four passes over (group, key, tie): give it rows that
are stored or cheap to compute. A bracket that missed its position is an error, never a result.

A null key sorts first, like Spark's ascending order. Keys are whole numbers below 2**53 (cents,
days, counts); `tie` must be unique within a group and not null.
"""
from __future__ import annotations

from collections.abc import Sequence
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Summary size; a bracket's half width; groups of fewer rows are counted whole.
ACCURACY, SLACK, SMALL = 10_000, 0.0005, 4_000
#: Steps of the summary of ties: a bracket is one step on either side.
GRID = 1_000
_LEAST, _MOST = -(2**63), 2**63 - 1


class Mark(NamedTuple):
    """The boundary after tile `t`: the key, the rows that tie at it, and which one it is."""

    group: tuple
    t: int
    key: int
    ties: int
    nth: int
    skip: int


class Cut(NamedTuple):
    """The last row of tile `t`; a null `tie` stands for all rows with that key."""

    t: int
    key: int
    tie: str | None


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver as a local relation."""
    kind = StructType.fromDDL(schema)
    table = pa.Table.from_pylist([dict(zip(kind.names, r)) for r in rows], schema=to_arrow_schema(kind))
    return spark.createDataFrame(table, schema=kind)


def _attach(df: DataFrame, group: Sequence[str], rows: list[tuple], schema: str) -> DataFrame:
    """`df` with the values of its group: a broadcast of one row a group, or literals where
    there is one group only."""
    if not group:
        return df.withColumns({f.name: F.lit(v).cast(f.dataType) for f, v in zip(StructType.fromDDL(schema), rows[0])})
    keys = ", ".join(f"`{g}` {df.schema[g].dataType.simpleString()}" for g in group)
    return df.join(F.broadcast(small_frame(df.sparkSession, rows, f"{keys}, {schema}")), list(group))


def _number(tie: Column, skip: Column) -> Column:
    """Six bytes of `tie` after `skip` hex digits as a number (exact as a double, which the
    summary holds): order-preserving."""
    part = F.rpad(F.hex(tie.cast("string")).substr(skip + 1, F.lit(12)), 12, "0")
    return F.conv(part, 16, 10).cast("long")


def _common(a: str, b: str) -> int:
    """The number of leading hex digits that two texts share."""
    a, b = a.encode().hex(), b.encode().hex()
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _running(counted: DataFrame, count: str, group: Sequence[str], order: Sequence) -> DataFrame:
    """`counted` with `_upto`, the running sum of `count` within its group."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.withColumn("_upto", F.sum(count).over(w))


def _marks(rows: DataFrame, tiles: int, group: list[str]) -> list[Mark]:
    """Steps 1 and 2 over rows(group, _v, _tie)."""
    ends = [x / tiles + d for d in (-SLACK, SLACK) for x in range(1, tiles)]
    stats = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", ends, ACCURACY).alias("_at"),
                                     F.min("_tie").alias("_a"), F.max("_tie").alias("_b")).filter("_n > 0").collect()
    brackets, skips = [], {}
    for r in stats:
        g, n, at = tuple(r[c] for c in group), r["_n"], r["_at"]
        lo, hi = ([_LEAST] * (tiles - 1), [_MOST] * (tiles - 1)) if n < SMALL else (at[:tiles - 1], at[tiles - 1:])
        brackets.append((*g, lo, hi, [t * (n // tiles) + min(t, n % tiles) for t in range(1, tiles)]))
        skips[g] = _common(r["_a"], r["_b"])
    if not brackets or tiles < 2:
        return []
    # Keys inside a bracket are counted one by one, those between two brackets together.
    placed = _attach(rows, group, [b[:-1] for b in brackets], "_lo array<long>, _hi array<long>")
    placed = placed.withColumn("_passed", sum(((F.col("_hi")[t] < F.col("_v")).cast("int") for t in range(tiles - 1)), F.lit(0)))
    inside = (F.col("_passed") < tiles - 1) & (F.get("_lo", F.col("_passed")) <= F.col("_v"))
    # Only a number is kept per key: with an array beside it Spark would sort all rows by their
    # keys first, where a hash table of the few keys does. The positions come to the counts.
    counted = placed.groupBy(*group, "_passed", F.when(inside, F.col("_v")).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    counted = _attach(counted, group, [(*b[:-3], b[-1]) for b in brackets], "_pos array<long>")
    counted = _running(counted, "_c", group, ["_passed", F.col("_v").asc_nulls_first()])
    wanted = F.transform("_pos", lambda p, i: F.struct((i + 1).alias("t"), (p - F.col("_upto") + F.col("_c")).alias("nth")))
    hit = F.filter(wanted, lambda m: (m["nth"] > 0) & (m["nth"] <= F.col("_c")))
    found = counted.select(*group, "_v", "_c", F.explode(hit).alias("_m")).collect()
    marks = [Mark(g := tuple(r[c] for c in group), r["_m"]["t"], r["_v"], r["_c"], r["_m"]["nth"], skips[g]) for r in found]
    if len(marks) != len(brackets) * (tiles - 1) or any(m.key is None for m in marks):
        raise ArithmeticError("a boundary lies outside its bracket")
    return marks


def _nth_ties(rows: DataFrame, marks: list[Mark], group: list[str]) -> dict[tuple, str]:
    """Step 3: the tie of each mark by (group, t)."""
    schema = "_v long, _t int, _nth long, _skip int, _low long, _high long"

    def ties(marks: list[Mark], near: dict) -> DataFrame:
        """The rows that tie at a mark's key, with their numbers."""
        keys = "".join(f"`{g}` {rows.schema[g].dataType.simpleString()}, " for g in group)
        small = small_frame(rows.sparkSession, [(*m.group, m.key, m.t, m.nth, m.skip, *near.get((m.group, m.t), (_LEAST, _MOST)))
                                           for m in marks], keys + schema)
        joined = rows.join(F.broadcast(small), [*group, "_v"])
        return joined.withColumn("_x", _number(F.col("_tie"), F.col("_skip")))

    near, many = {}, [m for m in marks if m.ties >= SMALL]
    if many:
        grid = [i / GRID for i in range(GRID + 1)]
        by = {(m.group, m.t): m for m in many}
        step = F.floor(F.col("_nth") * GRID / F.col("_n")).cast("int")
        for r in (ties(many, {}).groupBy(*group, "_t")
                  .agg(F.percentile_approx("_x", grid, ACCURACY).alias("_g"), F.count(F.lit(1)).alias("_n"), F.any_value("_nth").alias("_nth"))
                  .select(*group, "_t", F.get("_g", F.greatest(step - 1, F.lit(0))).alias("_low"),
                          F.get("_g", F.least(step + 2, F.lit(GRID))).alias("_high")).collect()):
            key = tuple(r[c] for c in group), r["_t"]
            near[by[key].group, key[1]] = (r["_low"], r["_high"])
    close = (ties(marks, near).filter(F.col("_x") <= F.col("_high"))
             .groupBy(*group, "_t", F.when(F.col("_x") >= F.col("_low"), F.col("_tie")).alias("_tie"))
             .agg(F.count(F.lit(1)).alias("_m"), F.any_value("_nth").alias("_nth")))
    close = _running(close, "_m", [*group, "_t"], [F.col("_tie").asc_nulls_first()])
    last = close.filter((F.col("_nth") <= F.col("_upto")) & (F.col("_nth") > F.col("_upto") - F.col("_m"))).collect()
    found = {(tuple(r[c] for c in group), r["_t"]): r["_tie"] for r in last}
    if len(found) != len(marks) or None in found.values():
        raise ArithmeticError("a boundary lies outside its bracket")
    return found


def key_cuts(rows: DataFrame, tiles: int, key: str, group: Sequence[str] = ()) -> dict[tuple, list[int]]:
    """By group, the key of the last row of each tile but the highest; with two tiles, the
    (lower) median. `key` is a bigint column without nulls."""
    marks = _marks(rows.select(*group, F.col(key).alias("_v"), F.lit("").alias("_tie")), tiles, list(group))
    out: dict[tuple, list[int]] = {}
    for m in sorted(marks, key=lambda m: m.t):
        out.setdefault(m.group, []).append(m.key)
    return out


def cut_points(rows: DataFrame, tiles: int, key: str, tie: str, group: Sequence[str] = ()) -> dict[tuple, list[Cut]]:
    """By group, the last row of each tile but the highest, by (key, tie). `key` is a bigint
    column."""
    group = list(group)
    rows = rows.select(*group, F.coalesce(key, F.lit(_LEAST)).alias("_v"), F.col(tie).cast("string").alias("_tie"))
    marks = _marks(rows, tiles, group)
    split = [m for m in marks if m.nth < m.ties]
    ties: dict[tuple, Any] = _nth_ties(rows, split, group) if split else {}
    out: dict[tuple, list[Cut]] = {}
    for m in sorted(marks, key=lambda m: m.t):
        out.setdefault(m.group, []).append(Cut(m.t, m.key, ties.get((m.group, m.t))))
    return out


def tile(cuts: Column, tiles: int, key: Column, tie: Column) -> Column:
    """The tile, 1 to `tiles`, of a row; `cuts` (array<struct<key, tie>>) are those of its group."""
    key = F.coalesce(key, F.lit(_LEAST))
    passed = []
    for t in range(tiles - 1):
        cut = F.get(cuts, F.lit(t))
        passed.append(F.when((key > cut["key"]) | ((key == cut["key"]) & (tie > cut["tie"])), 1).otherwise(0))
    return (sum(passed, F.lit(1))).cast("int")


def literal(cuts: list[Cut]) -> Column:
    """Cuts as a column, for rows of one group."""
    each = [F.struct(F.lit(c.key).cast("long").alias("key"), F.lit(c.tie).cast("string").alias("tie")) for c in cuts]
    return F.array(*each) if each else F.lit(None).cast("array<struct<key:long,tie:string>>")


def ntile(df: DataFrame, tiles: int, key: Column, tie: str, group: Sequence[str] = (), out_col: str = "ntile") -> DataFrame:
    """`df` with `out_col` = NTILE(tiles) over (group, ordered by key, tie)."""
    if tiles < 2:
        return df.withColumn(out_col, F.lit(1))
    keyed = df.withColumn("_key", key)
    cuts = cut_points(keyed, tiles, "_key", tie, group)
    if group:
        rows = [(*g, [{"key": c.key, "tie": c.tie} for c in each]) for g, each in cuts.items()]
        keyed = _attach(keyed, group, rows, "_cuts array<struct<key:long,tie:string>>")
    else:
        keyed = keyed.withColumn("_cuts", literal(cuts.get((), [])))
    return keyed.withColumn(out_col, tile(F.col("_cuts"), tiles, F.col("_key"), F.col(tie))).drop("_key", "_cuts")
