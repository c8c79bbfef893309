"""Repeatable train / validate / test splits of exact size.

Rows are ordered by a keyed hash of a unique key.  Two small counting passes over
hash prefixes find the hash at which each part ends; labelling is then a row-wise
comparison.  Nothing is sorted globally and no window spans the table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwork.functions.bounded import broadcast_if_small, join_group_rows

#: Distinct keys, as a share of the rows, below which a key is refused (the count is an estimate within 2 %).
UNIQUE_SHARE = 0.9
#: Values that are ordered in one go to find the n-th.
TOP_ROWS = 50_000
BUCKET_ROWS = 20_000
MAX_PREFIX = 5


def split_sizes(n: int, pct: float) -> tuple[int, int]:
    """Rows of the test and the validate part: ceil(pct * n), then ceil(2 * pct * rest)."""
    test = math.ceil(pct * n)
    return test, math.ceil(2 * pct * (n - test))


def split(
    df: DataFrame,
    key: str | Sequence[str],
    pct: float = 0.10,
    seed: int = 123,
    stratify: str | None = None,
    out: str = "split",
) -> DataFrame:
    """Add a ``split`` column: 'test', 'validate' or 'train'.

    ``key`` must identify rows: missing keys, or keys that repeat on a noticeable share of the rows, are an error, as those rows
    could not be told apart. With ``stratify`` each part holds the strata in
    proportion (largest remainder, equal remainders by stratum value), however many there are; strata of
    one row go to train.
    """
    keys = [key] if isinstance(key, str) else list(key)
    stratum = F.col(f"`{stratify}`") if stratify else F.lit(0)
    hashed = F.md5(F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in keys], F.lit(str(seed))))
    rows = df.select(stratum.alias("s"), hashed.alias("h"), *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])
    n = _checked_count(rows, keys)

    if stratify is None:
        targets = _cut_ranks({0: n}, pct)
        wanted = df.sparkSession.createDataFrame(targets, "ws int, part string, rank bigint") if targets else None
        cuts = [] if wanted is None else _cut_points(rows, F.broadcast(wanted), n, len(keys)).collect()
        bounds = {r["part"]: [F.lit(r["h"]), *[F.lit(r[f"k{i}"]) for i in range(len(keys))]] for r in cuts}
        labelled = df.withColumn("_h", hashed)
    else:
        fields = ["h", *[f"k{i}" for i in range(len(keys))]]
        wide = _cuts_per_stratum(rows, fields, pct, n)
        bounds = {p: [F.col(f"_{p}.{f}") for f in fields] for p in ("test", "validate")}
        labelled = join_group_rows(df.withColumns({"_h": hashed, "_s": F.struct(stratum.alias("s"))}), wide, ["_s"], "_n", how="left")
    here = [F.col("_h"), *[F.col(f"`{k}`") for k in keys]]
    label = F.lit("train")
    for part in ("validate", "test"):
        if part in bounds:
            label = F.when(F.coalesce(_not_after(here, bounds[part]), F.lit(False)), F.lit(part)).otherwise(label)
    return labelled.select(*[F.col(f"`{c}`") for c in df.columns if c != out], label.alias(out))


def split_views(df: DataFrame, out: str = "split") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three parts as frames: train, validate, test."""
    return tuple(df.where(F.col(out) == p).drop(out) for p in ("train", "validate", "test"))


def _not_after(left, right):
    """Lexicographic left <= right."""
    test = left[-1] <= right[-1]
    for a, b in reversed(list(zip(left[:-1], right[:-1]))):
        test = (a < b) | ((a == b) & test)
    return test


def _checked_count(rows, keys) -> int:
    """Number of rows; an error if keys are missing or clearly don't identify them."""
    absent = reduce(Column.__or__, [F.col(f"k{i}").isNull() for i in range(len(keys))])
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(absent).alias("absent"), F.approx_count_distinct("h", 0.02).alias("kinds")).first()
    if seen["absent"]:
        raise ValueError(f"{seen['absent']} rows without a value in {list(keys)}: they cannot be split repeatably")
    if seen["kinds"] < UNIQUE_SHARE * seen["n"]:
        raise ValueError(f"{list(keys)} has about {seen['kinds']} values in {seen['n']} rows: it does not identify them")
    return seen["n"]


def _allocate(total: int, counts: dict) -> dict:
    """Largest-remainder shares of ``total``, never more than a stratum holds."""
    n = sum(counts.values())
    order = sorted(counts, key=lambda s: (s is not None, s))
    share = {s: counts[s] * total // n if n else 0 for s in order}
    left = min(total, n) - sum(share.values())
    by_rest = sorted(order, key=lambda s: -(counts[s] * total % n) if n else 0)
    while left > 0:
        for s in by_rest:
            if left > 0 and share[s] < counts[s]:
                share[s] += 1
                left -= 1
    return share


def _cut_ranks(counts: dict, pct: float) -> list[tuple]:
    """(stratum, part, 0-based rank of the last row of the part)."""
    test_n, validate_n = split_sizes(sum(counts.values()), pct)
    usable = counts if len(counts) == 1 else {s: c for s, c in counts.items() if c > 1}
    test = _allocate(test_n, usable)
    validate = _allocate(validate_n, {s: c - test[s] for s, c in usable.items()})
    found = []
    for s in usable:
        if test[s]:
            found.append((s, "test", test[s] - 1))
        if validate[s]:
            found.append((s, "validate", test[s] + validate[s] - 1))
    return found


def _apportioned(strata: DataFrame, size: str, total: int) -> Column:
    """Largest-remainder shares of ``total`` as a column over ``strata`` (s, size); no list of strata is ever held.

    Remainders depend on the size alone, and there are at most about sqrt(2 n) different sizes of n rows: their counts tell the remainder at which the
    rest runs out, and of the strata with just that remainder those with the least values get the last ones.
    """
    sizes = [(r[0], r[1]) for r in strata.groupBy(size).agg(F.count(F.lit(1))).collect() if r[0]]
    n = sum(c * m for c, m in sizes)
    total = min(total, n)
    if not total:
        return F.lit(0).cast("bigint")
    left = total - sum(c * total // n * m for c, m in sizes)
    by_rest: dict[int, list] = {}
    for c, m in sizes:
        found = by_rest.setdefault(c * total % n, [0, []])
        found[0] += m
        found[1].append(c)
    product = F.col(size).cast("decimal(38,0)") * F.lit(total).cast("decimal(19,0)")
    low, rest = F.expr(f"CAST(`{size}` AS DECIMAL(19,0)) * CAST({total} AS DECIMAL(19,0)) DIV {n}"), product % F.lit(n).cast("decimal(38,0)")
    more = F.lit(0)
    for value in sorted(by_rest, reverse=True):
        if left <= 0:
            break
        many, classes = by_rest[value]
        here = rest == F.lit(value).cast("decimal(38,0)")
        if many > left:
            last = _nth(strata.where(F.col(size).isin(classes)), left)
            here = here & (F.col("s").isNull() if last is None else F.col("s").isNull() | (F.col("s") <= F.lit(last)))
            more = F.when(here, 1).otherwise(more)
            break
        # All remainders from here up are served: one comparison stands for them.
        more = F.when(rest >= F.lit(value).cast("decimal(38,0)"), 1).otherwise(F.lit(0))
        left -= many
    return F.when(F.col(size) > 0, low.cast("bigint") + more).otherwise(F.lit(0)).cast("bigint")


def _nth(frame: DataFrame, n: int):
    """The n-th value of ``s`` in ascending order, NULL first."""
    order = F.asc_nulls_first("s")
    if n > TOP_ROWS:
        # Ranges of the values, counted; only the range that holds the n-th is ordered.
        ranged = frame.select("s").repartitionByRange(order).withColumn("p", F.spark_partition_id()).persist()
        try:
            for p, m in sorted((r[0], r[1]) for r in ranged.groupBy("p").agg(F.count(F.lit(1))).collect()):
                if n <= m:
                    return ranged.where(F.col("p") == p).orderBy(order).limit(n).orderBy(F.desc_nulls_last("s")).first()["s"]
                n -= m
        finally:
            ranged.unpersist()
    return frame.select("s").orderBy(order).limit(n).orderBy(F.desc_nulls_last("s")).first()["s"]


def _cuts_per_stratum(rows, fields, pct, n):
    """One row per stratum with rows in test or validate: ``(_s, _n, _test, _validate)``, the last row of each part as a struct of ``fields``."""
    test_n, validate_n = split_sizes(n, pct)
    strata = rows.groupBy("s").agg(F.count(F.lit(1)).alias("c")).persist()
    try:
        alone = strata.limit(2).count() == 1
        usable = strata if alone else strata.where("c > 1")
        served = usable.withColumn("test", _apportioned(usable, "c", test_n)).withColumn("open", F.col("c") - F.col("test"))
        shared = served.withColumn("validate", _apportioned(served, "open", validate_n))
        largest = strata.agg(F.max("c")).first()[0] or 0
    finally:
        strata.unpersist()  # the counts are made again where the result is
    last = F.array(*[F.struct(F.lit(p).alias("part"), F.when(F.col(p) > 0, at - 1).alias("rank")) for p, at in (("test", F.col("test")), ("validate", F.col("test") + F.col("validate")))])
    wanted = shared.select(F.col("s").alias("ws"), F.inline(last)).where("rank is not null")
    cuts = _cut_points(rows, wanted, largest, len(fields) - 1)
    wide = cuts.groupBy("s").agg(*[F.max(F.when(F.col("part") == p, F.struct(*fields))).alias(f"_{p}") for p in ("test", "validate")])
    return wide.select(F.struct("s").alias("_s"), "_test", "_validate").join(strata.select(F.struct("s").alias("_s"), F.col("c").alias("_n")), "_s")


def _cut_points(rows, wanted, largest, n_keys):
    """Rows (s, part, h, k...): hash and key of the row at each rank of ``wanted`` (ws, part, rank)."""
    digits = min(MAX_PREFIX, max(1, math.ceil(math.log(max(1, largest / BUCKET_ROWS), 16))))
    bucketed = rows.select(F.struct("s").alias("g"), "*").withColumn("b", F.substring("h", 1, digits))
    sizes = bucketed.groupBy("g", "b").agg(F.count(F.lit(1)).alias("m"))
    spans = sizes.withColumn("upto", F.sum("m").over(Window.partitionBy("g").orderBy("b"))).withColumn("base", F.col("upto") - F.col("m"))
    hits = spans.join(wanted.select(F.struct(F.col("ws").alias("s")).alias("g"), "part", "rank"), "g").where("rank >= base AND rank < upto")
    hits = broadcast_if_small(hits.select("g", "b", "part", (F.col("rank") - F.col("base")).alias("local")))
    order = ["h", *[f"k{i}" for i in range(n_keys)]]
    ranked = bucketed.join(hits.select("g", "b"), ["g", "b"], "left_semi").withColumn("local", F.row_number().over(Window.partitionBy("g", "b").orderBy(*order)) - 1)
    return ranked.join(hits, ["g", "b", "local"]).select("s", "part", *order)
