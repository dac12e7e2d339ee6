"""Exact quantiles without gathering a group in one task.

Three narrow passes. The first builds Spark's mergeable quantile sketch and turns
each wanted quantile into a bracket of values that must contain it. The second
counts the values below each bracket's ends, which also proves every bracket. The
third takes only the values inside a bracket; these are counted by value and
ordered within bins of their bracket, so no task orders a whole bracket either.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from hearthrate.functions.nulls import number
from hearthrate.operators.skew import small_side
from hearthrate.session import settle

SKETCH_ACCURACY = 10_000
# Bracket half-width in ranks per row: four times the error the sketch promises.
MARGIN = 4 / SKETCH_ACCURACY
# Groups up to this size are counted whole: margins below two ranks prove nothing.
WHOLE_GROUP_ROWS = 10_000
# Columns per pass, and quantiles times columns per pass.
COLUMN_CHUNK = 60
EDGE_CHUNK = 240
# Up to so many quantiles are counted by one comparison each.
FEW_PROBS = 8
# Bins of equal width that a bracket's values are ordered in.
BINS = 64


def known_groups(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows whose group columns are all present."""
    for group in groups:
        df = df.where(F.col(group).isNotNull())
    return df


def _doubles(values: Sequence[float]) -> str:
    """A SQL array of doubles."""
    cells = ("double(NULL)" if v is None else f"double('{float(v)!r}')" for v in values)
    return "array(" + ", ".join(cells) + ")"


def _edges(index: int, probs: Sequence[float]) -> Column:
    """(rows, smallest, largest, lows, highs) around each wanted rank of one column, from its sketch."""
    whole, edges = f"rows{index} <= {WHOLE_GROUP_ROWS}", f"edges{index}"
    return F.expr(f"""struct(
        rows{index} AS rows, smallest{index} AS smallest, largest{index} AS largest,
        transform({_doubles(probs)}, (p, i) -> CASE WHEN {whole} OR p <= {MARGIN} THEN smallest{index}
                  ELSE {edges}[i] END) AS lows,
        transform({_doubles(probs)}, (p, i) -> CASE WHEN {whole} OR p >= 1 - {MARGIN} THEN largest{index}
                  ELSE {edges}[{len(probs)} + i] END) AS highs)""")


def _brackets(df: DataFrame, columns: Sequence[str], probs: Sequence[float], groups: Sequence[str]) -> DataFrame:
    """One row per group with a struct ``b<i>`` (rows, lows, highs) per column: one pass, nothing exploded."""
    around = [max(0.0, p - MARGIN) for p in probs] + [min(1.0, p + MARGIN) for p in probs]
    sketches = []
    for i, name in enumerate(columns):
        value = number(df, name)
        sketches += [
            F.count(value).alias(f"rows{i}"),
            F.min(value).alias(f"smallest{i}"),
            F.max(value).alias(f"largest{i}"),
            F.percentile_approx(value, around, SKETCH_ACCURACY).alias(f"edges{i}"),
        ]
    wide = df.groupBy(*groups).agg(*sketches)
    return wide.select(*groups, *[_edges(i, probs).alias(f"b{i}") for i in range(len(columns))])


def _passed(index: int, size: int) -> Column:
    """How many brackets end below the value."""
    if size <= 8:
        return F.expr(" + ".join(f"int(highs{index}[{k}] < v{index})" for k in range(size)))
    return F.expr(f"size(filter(highs{index}, high -> high < v{index}))")


def _beyond(index: int, lows: Sequence[Column], highs: Sequence[Column]) -> list[Column]:
    """Aggregates: how many values lie below each bracket, and up to its end."""
    value = F.col(f"v{index}")
    under = [F.count(F.when(value < low, 1)) for low in lows]
    upto = [F.count(F.when(value <= high, 1)) for high in highs]
    return [F.array(*under).alias(f"under{index}"), F.array(*upto).alias(f"upto{index}")]


def _counts(values: DataFrame, brackets: DataFrame, small: bool, groups: Sequence[str], count: int, probs: int) -> DataFrame:
    """(groups, under<i>, upto<i>) of every column; without groups the edges are constants."""
    if groups:
        edged = _edge_columns(values, brackets, small, groups, count)
        sides = [[[F.get(f"{edge}{i}", k) for k in range(probs)] for edge in ("lows", "highs")] for i in range(count)]
        return edged.groupBy(*groups).agg(*[part for i in range(count) for part in _beyond(i, *sides[i])])
    row = brackets.first()
    bounds = [[[F.lit(x).cast("double") for x in row[f"b{i}"][edge] or [None] * probs] for edge in ("lows", "highs")] for i in range(count)]
    return values.agg(*[part for i in range(count) for part in _beyond(i, *bounds[i])])


def _proven(index: int, probs: Sequence[float]) -> Column:
    """(rows, lows, highs, base): brackets that hold their ranks, and the rank each one's first value has.

    Should a sketch have missed, the counts show it, and the column's brackets become
    the whole range of its values: slower, still exact.
    """
    b, wanted = f"b{index}", _doubles(probs)
    missed = f"""exists(transform({wanted}, (p, i) -> floor(({b}.rows - 1) * p) < under{index}[i]
        OR ceil(({b}.rows - 1) * p) >= upto{index}[i]), miss -> miss)"""
    return F.expr(f"""struct({b}.rows AS rows,
        CASE WHEN {missed} THEN transform({wanted}, p -> {b}.smallest) ELSE {b}.lows END AS lows,
        CASE WHEN {missed} THEN transform({wanted}, p -> {b}.largest) ELSE {b}.highs END AS highs,
        transform({wanted}, (p, i) -> CASE WHEN i = 0 THEN CASE WHEN {missed} THEN 0L ELSE under{index}[0] END
            ELSE greatest(under{index}[i], upto{index}[i - 1]) END) AS base)""")


def _proven_by_place(values: DataFrame, brackets: DataFrame, probs: Sequence[float], count: int) -> DataFrame:
    """As ``_proven`` for many quantiles of ungrouped columns, from one narrow count.

    Values are counted by the bracket they lie in or before: at most two rows
    for each quantile and column come to the driver.
    """
    placed = _edge_columns(values, brackets, True, (), count).withColumns({f"p{i}": _passed(i, len(probs)) for i in range(count)})
    placed = placed.withColumns({f"in{i}": F.col(f"v{i}") >= F.get(f"lows{i}", F.col(f"p{i}")) for i in range(count)})
    cells = F.array(*[F.struct(F.lit(i).alias("at"), F.col(f"p{i}").alias("p"), F.coalesce(f"in{i}", F.lit(False)).alias("inside"), F.col(f"v{i}").isNotNull().alias("known")) for i in range(count)])
    rows = placed.select(F.explode(cells).alias("c")).where("c.known").groupBy("c.at", "c.p", "c.inside").count().collect()
    state, known = {}, brackets.first()
    for i in range(count):
        b, m = known[f"b{i}"], len(probs)
        held = [[0, 0] for _ in range(m + 1)]
        for r in rows:
            if r["at"] == i:
                held[r["p"]][r["inside"]] += r["count"]
        before = [sum(map(sum, held[:k])) for k in range(m + 2)]
        base, end = [before[k] + held[k][0] for k in range(m)], before[1:m + 1]
        ranks = {e for p in probs for e in (math.floor((b["rows"] - 1) * p), math.ceil((b["rows"] - 1) * p))} if b["rows"] else set()
        spans = [(x, y) for x, y in zip(base, end) if x < y]
        if all(any(x <= r < y for x, y in spans) for r in ranks):
            state[f"b{i}"] = (b["rows"], b["lows"], b["highs"], base)
        else:
            state[f"b{i}"] = (b["rows"], [b["smallest"]] * m, [b["largest"]] * m, [0] + [b["rows"]] * (m - 1))
    schema = ", ".join(f"b{i} struct<rows:bigint,lows:array<double>,highs:array<double>,base:array<bigint>>" for i in range(count))
    return values.sparkSession.createDataFrame([tuple(state[f"b{i}"] for i in range(count))], schema)


def _edge_columns(values: DataFrame, state: DataFrame, small: bool, groups: Sequence[str], count: int) -> DataFrame:
    """Add ``lows<i>`` and ``highs<i>`` of the row's group to the values ``v<i>``."""
    edges = ("lows", "highs")
    if groups:
        side = state.select(*groups, *[F.col(f"b{i}.{edge}").alias(f"{edge}{i}") for i in range(count) for edge in edges])
        return values.join(F.broadcast(side) if small else side, list(groups))
    constants = state.first()
    return values.select("*", *[
        F.expr(_doubles(constants[f"b{i}"][edge] or [])).alias(f"{edge}{i}") for i in range(count) for edge in edges
    ])


def _inside(values: DataFrame, count: int, probs: int, groups: Sequence[str]) -> DataFrame:
    """(groups, at, slot, bin, value) of every value that lies in a bracket of its column ``at``."""
    every = range(count)
    passed = values.withColumns({f"p{i}": _passed(i, probs) for i in every})
    low, high = (lambda i: F.get(f"lows{i}", F.col(f"p{i}"))), (lambda i: F.get(f"highs{i}", F.col(f"p{i}")))
    inside = passed.withColumns({
        f"in{i}": F.coalesce((F.col(f"p{i}") < probs) & (F.col(f"v{i}") >= low(i)), F.lit(False)) for i in every
    })

    def cell(i: int) -> Column:
        share = F.try_divide(F.col(f"v{i}") - low(i), high(i) - low(i))
        place = F.when(share.between(0.0, 1.0), F.floor(share * (BINS - 1))).otherwise(0)
        return F.when(F.col(f"in{i}"), F.struct(
            F.lit(i).alias("at"), F.col(f"p{i}").alias("slot"), place.cast("int").alias("bin"), F.col(f"v{i}").alias("value")))

    # A row without such a value has an empty array and ends here; a filter would compute the places twice.
    return inside.select(*groups, F.explode(F.array_compact(F.array(*[cell(i) for i in every]))).alias("cell")).select(*groups, "cell.*")


def quantile_table(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], groups: Sequence[str] = ()
) -> DataFrame:
    """(groups, column, rows, q): exact linearly interpolated quantiles, ``q`` in the order of ``probs``.

    ``probs`` must ascend. Columns without any value yield no row. Rows with a
    null group drop out.
    """
    if list(probs) != sorted(probs):
        raise ValueError("probs must ascend")
    width = max(1, min(COLUMN_CHUNK, EDGE_CHUNK // len(probs)))
    if len(columns) > width:
        parts = [columns[i : i + width] for i in range(0, len(columns), width)]
        return reduce(DataFrame.unionByName, [quantile_table(df, part, probs, groups) for part in parts])
    groups, every = list(groups), range(len(columns))
    kept = known_groups(df, groups)
    values = kept.select(*groups, *[number(kept, c).alias(f"v{i}") for i, c in enumerate(columns)])
    brackets, small = small_side(_brackets(kept, columns, probs, groups)) if groups else (settle(_brackets(kept, columns, probs, ())), True)
    if not groups and len(probs) > FEW_PROBS:
        state = _proven_by_place(values, brackets, probs, len(columns))
    else:
        counts = _counts(values, brackets, small, groups, len(columns), len(probs))
        both = brackets.join(counts, groups) if groups else brackets.crossJoin(counts)
        proven = both.select(*groups, *[_proven(i, probs).alias(f"b{i}") for i in every])
        state, small = small_side(proven) if groups else (settle(proven), True)

    # In order: slots, bins of a slot, values of a bin. Only values of one bin meet in a task.
    chosen = _inside(_edge_columns(values, state, small or not groups, groups, len(columns)), len(columns), len(probs), groups)
    keys = [*groups, "at"]
    counted = chosen.groupBy(*keys, "slot", "bin", "value").agg(F.count(F.lit(1)).alias("n"))
    per_bin = counted.groupBy(*keys, "slot", "bin").agg(F.sum("n").alias("held"))
    earlier = Window.partitionBy(*keys, "slot").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bin.select(*keys, "slot", "bin", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("offset"))
    starts = state.select(*groups, F.explode(F.array(*[
        F.struct(F.lit(i).alias("at"), F.col(f"b{i}.rows").alias("rows"), F.col(f"b{i}.base").alias("base")) for i in every
    ])).alias("start")).select(*groups, "start.*")
    along = Window.partitionBy(*keys, "slot", "bin").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ordered = counted.withColumn("within", F.sum("n").over(along)).join(offsets, [*keys, "slot", "bin"])
    ordered = ordered.join(F.broadcast(starts) if small else starts, keys)

    # Each counted value answers the wanted ranks it covers: at most two per quantile and group.
    last = F.get("base", F.col("slot")) + F.col("offset") + F.col("within")
    wanted = F.expr(f"""flatten(transform({_doubles(probs)}, (p, i) -> array(
        named_struct('place', 2 * i, 'rank', floor((rows - 1) * p)),
        named_struct('place', 2 * i + 1, 'rank', ceil((rows - 1) * p)))))""")
    hits = ordered.withColumn("last", last).withColumn(
        "hit", F.explode(F.filter(wanted, lambda w: (w["rank"] >= F.col("last") - F.col("n")) & (w["rank"] < F.col("last")))))
    found = hits.groupBy(*keys, "rows").agg(F.array_sort(F.collect_list(F.struct("hit.place", "value"))).alias("found"))
    answers = F.expr(f"""transform({_doubles(probs)}, (p, i) -> found[2 * i].value
        + (found[2 * i + 1].value - found[2 * i].value) * ((rows - 1) * p - floor((rows - 1) * p)))""")
    name = F.get(F.array(*[F.lit(c) for c in columns]), F.col("at"))
    return found.select(*groups, name.alias("column"), "rows", answers.alias("q"))


def group_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """One row per group with a named column per quantile."""
    table = quantile_table(df, [value], probs, groups)
    return table.select(*groups, *[F.col("q")[i].alias(name) for i, name in enumerate(names)])


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Fitted quantiles per column as driver scalars (one row per column)."""
    rows = quantile_table(df, columns, probs).collect() if columns else []
    return {row["column"]: list(row["q"]) for row in rows}


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    return {name: q[0] for name, q in column_quantiles(df, columns, [0.5]).items()}


def scalar_quantile(df: DataFrame, column: str, prob: float) -> float | None:
    found = column_quantiles(df, [column], [prob])
    return found[column][0] if column in found else None
