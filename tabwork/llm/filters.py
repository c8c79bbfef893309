"""What each of several document filters removes, in every order of applying them.

A document is reduced to its mask, the set of filters that it fails; after that only the counts of
masks matter, of which there are at most 2^k in each part. Orders are ranked lexicographically (their
Lehmer rank). Orders that begin with the same s letters are consecutive ranks, (k - s)! of them, so a mask
is removed at step s by a given filter in whole intervals of ranks: those of each prefix whose last
letter is the only one the mask fails. Each interval adds the count of the mask at its first rank and
takes it away behind its last; a running sum over the k! ranks gives the removals of every order at once,
and nothing is computed order by order.

Identical texts are found by their SHA-256: the least id of each text is joined back by (digest, id), a
key that a text of any number of copies doesn't make hot.

Defined results: a NULL text counts as empty, a NULL part as the empty string; rows that share the least id of a
text are none of them repeats; a row with a NULL id is never a repeat and makes none; a document is
good or toxic if any label row of its id says so; rows of ``labels`` for other ids, and other columns, are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwork.llm.common import stored

#: What counts of documents are carried through, as columns of the masks.
COUNTS = ("n", "good", "toxic")
#: k! ranks for each part and step are held in one task's window; more filters than this would make that large.
MOST_FILTERS = 7


def text_failures(text: Column) -> dict[str, Column]:
    """The failure conditions that a text alone decides. ``text`` must not be NULL."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 2 * F.length(text),
        "D": F.rlike(text, F.lit(r"[#$%&*|]")),
    }


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """Rows (part, mask, n, good, toxic): documents by the letters they fail, bit 0 for A; E is a text that a smaller id has."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    failed = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_failures(text).values())]
    rows = docs.select("doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"), reduce(Column.__add__, failed).alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = stored(spark, rows, "masks")
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    named = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    repeat = F.when(F.col("first").isNull() & F.col("doc_id").isNotNull(), 1 << len(failed)).otherwise(0)
    known = rows.join(least, ["digest", "doc_id"], "left").join(named, "doc_id", "left")
    masks = known.select("part", (F.col("mask") + repeat).alias("mask"), "good", "toxic")
    return masks.groupBy("part", "mask").agg(
        F.count("*").alias("n"), *[F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in ("good", "toxic")])


def rank_intervals(filters: str) -> list[tuple[int, int, int, int, int]]:
    """Rows (mask, step, letter, low, high): ranks low .. high - 1 are the orders in which filter ``letter`` removes the mask at that step."""
    k, found = len(filters), []
    for step in range(1, k + 1):
        width = factorial(k - step)
        for prefix in permutations(range(k), step):
            low = sum(sum(x < f for x in range(k) if x not in prefix[:i]) * factorial(k - 1 - i) for i, f in enumerate(prefix))
            rest = [x for x in range(k) if x not in prefix]
            for more in range(len(rest) + 1):
                found += [(sum(1 << x for x in (prefix[-1], *others)), step, prefix[-1], low, low + width) for others in combinations(rest, more)]
    return found


def audit(masks: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """One row per part, order of ``filters`` and step, from rows (part, mask, n, good, toxic); see ``mask_counts``.

    kept and removed, good_lost and toxic_lost at the step; redundant: documents that its filter fails but an earlier one removed; unique_fails:
    those that only its filter fails; shapley: what its filter removes, over all orders.
    """
    if not 1 <= len(filters) <= MOST_FILTERS or len(set(filters)) != len(filters) or sorted(filters) != list(filters):
        raise ValueError(f"filters are 1 to {MOST_FILTERS} different letters in order")
    spark, k = masks.sparkSession, len(filters)
    masks = stored(spark, masks.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS]), "parts")
    # A table of fixed size, whatever the documents are.
    intervals = F.broadcast(spark.createDataFrame(rank_intervals(filters), "mask int, step int, letter int, low int, high int"))
    spans = masks.join(intervals, "mask")
    ends = spans.select("part", "step", F.explode(F.array(*[
        F.struct(F.col(rank).alias("rank"), *[(sign * F.col(c)).alias(c) for c in COUNTS]) for rank, sign in (("low", 1), ("high", -1))])).alias("end"))
    changes = ends.select("part", "step", "end.*").where(F.col("rank") < factorial(k))
    every = masks.select("part").distinct().select("part", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))
    grid = every.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(factorial(k) - 1))).alias("rank"), *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    summed = changes.unionByName(grid).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])
    upto = Window.partitionBy("part", "step").orderBy("rank")
    removed = summed.select("part", "step", "rank", *[F.sum(c).over(upto).alias(c) for c in COUNTS])

    orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    removed = removed.withColumn("filter_order", F.get(orders, F.col("rank")))
    removed = removed.withColumn("letter", F.position(F.substr("filter_order", F.col("step"), F.lit(1)), F.lit(filters)) - 1)
    whole = masks.groupBy("part").agg(F.sum("n").alias("whole"))
    fails = masks.select("part", "mask", "n", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("letter"))
    fails = fails.groupBy("part", "letter").agg(
        F.sum(F.expr("IF(shiftright(mask, letter) % 2 = 1, n, 0)")).alias("fails"),
        F.sum(F.expr("IF(mask = shiftleft(1, letter), n, 0)")).alias("unique_fails"))
    credit = spans.groupBy("part", "letter").agg(F.sum(F.col("n") * (F.col("high") - F.col("low"))).alias("shapley"))
    through = Window.partitionBy("part", "rank").orderBy("step")
    told = removed.join(whole, "part").join(fails, ["part", "letter"]).join(credit, ["part", "letter"], "left")
    return told.select(
        "part", "filter_order", "step", (F.col("whole") - F.sum("n").over(through)).alias("kept"), F.col("n").alias("removed"),
        (F.col("fails") - F.col("n")).alias("redundant"), "unique_fails", F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.coalesce("shapley", F.lit(0)).cast("long").alias("shapley"))
