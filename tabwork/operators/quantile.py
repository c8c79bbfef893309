"""Quantiles (linear interpolation), exact or sketched, whole-column or per group, at any size.

Sketches: each task sketches its rows (KLL), the sketches of a few tasks are merged, and then those few; no
task ever merges more than ``SALTS`` buffers of a group, and a buffer has a fixed size.

Exact: columns with few distinct values are counted by value first, and a weighted ``percentile`` goes over
those counts. The values of other columns are cut into cells at the sketched quantiles on either side of
each wanted rank; every cut point is a cell of its own, so a very frequent value stands alone. Counts of the cells
tell which of them hold the wanted ranks. Cells of one value are done, crowded ones are cut again by a
sketch of their own, in each group by itself, and only the rows of the remaining ones are ranked, equal values counted
together. The sketches decide balance only, never the answer.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwork.functions.bounded import broadcast_if_small, rows_if_small
from tabwork.functions.missing import normalize_missing

MAX_DISTINCT = 200_000
#: A series of up to so many rows is ranked at once.
CELL_ROWS = 200_000
#: A cell of more rows is cut again.
CROWDED_ROWS = 1_000_000
REFINEMENTS = 4
MANY_QUANTILES = 50
#: Size of a sketch, and the rank error on one side that it keeps to nearly always.
SKETCH_K = 4096
SKETCH_ERROR = 0.001
#: Sketches of one group that one task merges at most, in the second of the two levels.
SALTS = 64
#: Cut points of a series or cell at most, and numbers that its cells then take.
MAX_CUTS = 63
_CELLS = 2 * MAX_CUTS + 2


def _array(values: Sequence[float]) -> Column:
    """A constant array; written as text, since a thousand separate literals plan slowly."""
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


def _sketched(data: DataFrame, keys: Sequence[str], cols: Sequence[str], distinct: bool = False) -> DataFrame:
    """Rows ``(keys..., n0, k0, d0, n1, ...)``: count, sketch and estimated distinct values of each column, merged in two levels."""
    x = [F.col(f"`{c}`") for c in cols]
    salted = data.withColumn("_salt", F.spark_partition_id() % SALTS)
    low = salted.groupBy(*keys, "_salt").agg(*[
        a for i, v in enumerate(x)
        for a in (F.count(v).alias(f"n{i}"), F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias(f"k{i}"),
                  *([F.hll_sketch_agg(F.xxhash64(v), F.lit(12)).alias(f"d{i}")] if distinct else []))
    ])
    return low.groupBy(*keys).agg(*[
        a for i in range(len(x))
        for a in (F.sum(f"n{i}").alias(f"n{i}"), F.kll_merge_agg_double(f"k{i}", F.lit(SKETCH_K)).alias(f"k{i}"),
                  *([F.hll_sketch_estimate(F.hll_union_agg(f"d{i}")).alias(f"d{i}")] if distinct else []))
    ])


def _at_ranks(sketch: str, n: str, points: Sequence[float]) -> Column:
    """Sketched quantiles as an array; NULL for an empty sketch."""
    return F.when(F.col(n) > 0, F.kll_sketch_get_quantile_double(F.col(sketch), _array(points)))


def approximate_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(by..., column, n, q)`` like ``exact_quantiles``, each an existing value within ``SKETCH_ERROR`` of its rank, from one pass."""
    cols, by = list(cols), list(by)
    data = normalize_missing(df.select(*[F.col(f"`{b}`") for b in by], *[F.col(f"`{c}`").cast("double").alias(c) for c in cols]), cols)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), _at_ranks(f"k{i}", f"n{i}", qs).alias("q")) for i, c in enumerate(cols)
    ])
    return _sketched(data, by, cols).select(*[F.col(f"`{b}`") for b in by], F.inline(rows)).where("n > 0")


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    qs: Sequence[float],
    by: Sequence[str] = (),
    max_distinct: int = MAX_DISTINCT,
    cell_rows: int = CELL_ROWS,
    crowded_rows: int = CROWDED_ROWS,
) -> DataFrame:
    """Rows ``(by..., column, n, q)`` where ``q`` is an array aligned with ``qs``.

    A series without any value gives no row.
    """
    cols, by = list(cols), list(by)
    if not cols:
        raise ValueError("no columns given")
    data = normalize_missing(df.select(*by, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols]), cols)
    if by:
        return _by_cells(data, dict(enumerate(cols)), qs, by, None, cell_rows, crowded_rows)
    points = _cut_ranks(qs)
    probe = _sketched(data, [], cols, distinct=True).select(*[
        a for i in range(len(cols)) for a in (f"n{i}", f"d{i}", _at_ranks(f"k{i}", f"n{i}", points).alias(f"e{i}"))
    ]).first()
    # percentile works through its whole buffer for every quantile asked.
    limit = max_distinct if len(qs) <= MANY_QUANTILES else min(max_distinct, 1000)
    small = {i: c for i, c in enumerate(cols) if (probe[f"d{i}"] or 0) <= limit}
    large = {i: c for i, c in enumerate(cols) if i not in small}
    parts = []
    if small:
        parts.append(_by_percentile(data, small, qs))
    if large:
        edges = {i: sorted(set(probe[f"e{i}"])) if probe[f"n{i}"] > cell_rows else [] for i in large}
        parts.append(_by_cells(data, large, qs, [], edges, cell_rows, crowded_rows))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def quantile_dict(df: DataFrame, cols: Sequence[str], qs: Sequence[float], **options) -> dict[str, list[float]]:
    """Whole-column quantiles on the driver: one small row per column."""
    rows = exact_quantiles(df, cols, qs, **options).collect()
    found = {r["column"]: list(r["q"]) for r in rows}
    return {c: found.get(c) for c in cols}


def _cut_ranks(qs: Sequence[float]) -> list[float]:
    """Ranks just beside the wanted ones, or even ones if those would be too many."""
    beside = sorted({min(1.0, max(0.0, q + side * 2 * SKETCH_ERROR)) for q in qs for side in (-1, 1)})
    return beside if len(beside) <= MAX_CUTS else [k / MAX_CUTS for k in range(1, MAX_CUTS)]


def _long(data, cols, by, *more):
    """Rows ``(by..., series, x, more...)`` of every value; ``more`` are functions of series and column."""
    return data.select(*[F.col(f"`{b}`") for b in by], F.inline(F.array(*[
        F.struct(F.lit(i).alias("series"), F.col(f"`{c}`").alias("x"), *[f(i, c) for f in more]) for i, c in cols.items()
    ]))).where("x is not null")


def _by_percentile(data, cols, qs):
    counted = _long(data, cols, []).groupBy("series", "x").agg(F.count(F.lit(1)).alias("c"))
    found = counted.groupBy("series").agg(F.sum("c").alias("n"), F.percentile("x", _array(qs), F.col("c")).alias("q"))
    return found.select(_named(cols), "n", "q")


def _named(cols):
    return F.element_at(F.create_map(*[F.lit(v) for i, c in cols.items() for v in (i, c)]), F.col("series")).alias("column")


def _cell_text(x: str, edges: Sequence[float], low: int = 0) -> str:
    """Cell of x by halving: odd numbers are the cut points themselves, even ones the gaps between them."""
    if not edges:
        return f"{2 * low}L"
    middle = len(edges) // 2
    at = f"{edges[middle]!r}D" if math.isfinite(edges[middle]) else f"double('{'-' if edges[middle] < 0 else ''}Infinity')"
    return (f"CASE WHEN {x} = {at} THEN {2 * (low + middle) + 1}L WHEN {x} < {at} THEN {_cell_text(x, edges[:middle], low)} "
            f"ELSE {_cell_text(x, edges[middle + 1:], low + middle + 1)} END")


def _cell_in(edges: Column, x: Column) -> Column:
    """The same for cut points in an array column."""
    return (F.size(F.filter(edges, lambda e: e < x)) + F.size(F.filter(edges, lambda e: e <= x))).cast("long")


def _joined(left, right, names, how="inner"):
    """``left`` with the columns that ``right`` has besides ``names``, NULL keys equal."""
    renamed = right.withColumnsRenamed({n: f"_{i}" for i, n in enumerate(names)})
    condition = None
    for i, name in enumerate(names):
        term = left[name].eqNullSafe(renamed[f"_{i}"])
        condition = term if condition is None else condition & term
    return left.join(renamed, condition, how).drop(*[f"_{i}" for i in range(len(names))])


def _by_cells(data, cols, qs, by, edges, cell_rows, crowded_rows):
    keys = [*by, "series"]
    if by:
        top = _sketched(data, by, list(cols.values()))
        rows = F.array(*[F.struct(F.lit(i).alias("series"), F.when(F.col(f"n{j}") > cell_rows, F.array_distinct(_at_ranks(f"k{j}", f"n{j}", _cut_ranks(qs)))).alias("cuts"))
                         for j, i in enumerate(cols)])
        cuts = top.select(*[F.col(f"`{b}`") for b in by], F.inline(rows)).where("cuts is not null")
        known = rows_if_small(cuts)
        if known == []:
            return _interpolated(_ranked_at_once(_long(data, cols, by), keys, qs), by, cols, qs)
        cuts = cuts if known is None else F.broadcast(data.sparkSession.createDataFrame(known, cuts.schema))
        values = _joined(_long(data, cols, by), cuts, keys, "left").select(*keys, "x", F.coalesce(_cell_in(F.col("cuts"), F.col("x")), F.lit(0)).alias("cell"))
    elif not any(edges.values()):
        return _interpolated(_ranked_at_once(_long(data, cols, []), keys, qs), by, cols, qs)
    else:
        values = _long(data, cols, [], lambda i, c: F.expr(_cell_text(f"`{c}`", edges[i])).alias("cell"))
    hits = _hits(values, keys, qs)
    for attempt in range(REFINEMENTS + 1):
        open_cells, some = _small(hits)
        crowded = (F.col("m") > crowded_rows) & (F.col("low") < F.col("high"))
        if attempt == REFINEMENTS or not some(crowded):
            break
        # The finished ones go aside; crowded cells are cut again, each by a sketch of its own rows.
        settled = open_cells.where(~crowded)
        tight = _cut_again(values, open_cells.where(crowded), keys)
        kept = _joined(values, broadcast_if_small(settled.select(*keys, "cell")), [*keys, "cell"], "left_semi")
        inner = _joined(values, broadcast_if_small(tight), [*keys, "cell"]).select(
            *keys, "x", (F.col("cell") * _CELLS + _cell_in(F.col("cuts"), F.col("x"))).alias("cell"), "base", "n", "ranks")
        below = _spans(inner.groupBy(*keys, (F.floor(F.col("cell") / _CELLS)).alias("outer"), "cell").agg(
            F.count(F.lit(1)).alias("m"), F.min("x").alias("low"), F.max("x").alias("high"), F.first("base").alias("first"), F.first("n").alias("n"), F.first("ranks").alias("ranks"),
        ), [*keys, "outer"])
        hits = settled.withColumn("cell", F.col("cell") * _CELLS).unionByName(_holding(below.withColumn("base", F.col("before") + F.col("first")), keys))
        values = kept.select(*keys, "x", (F.col("cell") * _CELLS).alias("cell")).unionByName(inner.select(*keys, "x", "cell"))
    hits = open_cells

    # Cells of one value are done; the others are ranked inside, equal values counted together before.
    single = hits.where("low = high").select(*keys, "n", F.col("low").alias("x"), F.explode("ranks").alias("rank"))
    ranked = hits.where("low < high")
    counted = _joined(values, ranked.select(*keys, "cell"), [*keys, "cell"], "left_semi").groupBy(*keys, "cell", "x").agg(F.count(F.lit(1)).alias("c"))
    running = counted.withColumn("upto", F.sum("c").over(Window.partitionBy(*keys, "cell").orderBy("x")))
    picked = _joined(running, ranked.select(*keys, "cell", "base", "n", "ranks"), [*keys, "cell"]).select(
        *keys, "n", "x",
        F.explode(F.filter(F.col("ranks"), lambda r: (r - F.col("base") >= F.col("upto") - F.col("c")) & (r - F.col("base") < F.col("upto")))).alias("rank"),
    )
    return _interpolated(picked.unionByName(single), by, cols, qs)


def _ranked_at_once(values, keys, qs):
    """Rows ``(keys..., n, x, rank)`` of the wanted ranks, for series of few rows: each is ranked whole, equal values counted before."""
    counted = values.groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("c"))
    series = Window.partitionBy(*keys)
    running = counted.select(*keys, "x", "c", F.sum("c").over(series.orderBy("x")).alias("upto"), F.sum("c").over(series).alias("n"))
    here = F.filter(_ranks(qs), lambda r: (r >= F.col("upto") - F.col("c")) & (r < F.col("upto")))
    return running.select(*keys, "n", "x", F.explode(here).alias("rank"))


def _ranks(qs):
    """The ranks from 0 that quantiles of ``n`` values lie between."""
    return F.array_distinct(F.flatten(F.transform(_array(qs), lambda q: F.array(
        F.floor(q * (F.col("n") - 1)).cast("bigint"), F.ceil(q * (F.col("n") - 1)).cast("bigint")
    ))))


def _interpolated(picked, by, cols, qs):
    # At most two rows per wanted quantile and series.
    found = picked.groupBy(*by, "series").agg(
        F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("at")
    )

    def value(q):
        p = q * (F.col("n") - 1)
        low, high = F.floor(p).cast("bigint"), F.ceil(p).cast("bigint")
        a, b = F.col("at")[low], F.col("at")[high]
        return F.when((low == high) | (a == b), a).otherwise((high - p) * a + (p - low) * b)

    return found.select(*by, _named(cols), "n", F.transform(_array(qs), value).alias("q"))


def _small(hits):
    """The frame itself, or its rows made a broadcast, and a test whether some row meets a condition."""
    rows = rows_if_small(hits)
    if rows is None:
        return hits, lambda condition: not hits.where(condition).isEmpty()
    frame = hits.sparkSession.createDataFrame(rows, hits.schema)
    return F.broadcast(frame), lambda condition: not frame.where(condition).isEmpty()


def _spans(per_cell, keys):
    """Adds how many rows of a series come before each cell; the windows see counts of cells only."""
    return per_cell.withColumn("before", F.sum("m").over(Window.partitionBy(*keys).orderBy("cell")) - F.col("m"))


def _holding(spans, keys):
    """Cells ``(keys..., cell, base, n, ranks, m, low, high)`` that hold wanted ranks, with those."""
    inside = F.filter(F.col("ranks"), lambda r: (r >= F.col("base")) & (r < F.col("base") + F.col("m")))
    return spans.select(*keys, "cell", "base", "n", inside.alias("ranks"), "m", "low", "high").where(F.size("ranks") > 0)


def _hits(values, keys, qs):
    per_cell = values.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("m"), F.min("x").alias("low"), F.max("x").alias("high"))
    whole = _spans(per_cell, keys).withColumn("n", F.sum("m").over(Window.partitionBy(*keys)))
    return _holding(whole.select(*keys, "cell", "m", "low", "high", "n", F.col("before").alias("base"), _ranks(qs).alias("ranks")), keys)


def _cut_again(values, crowded, keys):
    """``crowded`` cells with cut points at even ranks of their own rows."""
    names = [*keys, "cell"]
    inner = _joined(values, crowded.select(*names), names, "left_semi")
    cuts = F.array_distinct(_at_ranks("k0", "n0", [k / (MAX_CUTS + 1) for k in range(1, MAX_CUTS + 1)]))
    return _joined(crowded.select(*names, "base", "n", "ranks"), _sketched(inner, names, ["x"]).select(*names, cuts.alias("cuts")), names)
