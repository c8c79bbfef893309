"""Benchmark decontamination: a broadcast hash set of the benchmark's word n-grams scanned over every document.

Texts are lower-cased (A-Z) and cut into words of digits, letters and characters beyond
ASCII. An item's windows are its runs of ``window`` words; an item of fewer words is one
window. Windows are cut from the items in Spark, and the hash set sent to the tasks stays bounded: windows whose
spelling takes more than ``max_chars`` characters are taken in blocks, one after the other. A block's scan writes only the
spans and items of the distinct texts that it hits, and the last step joins them to the documents by the text's SHA-256; of the texts nothing
is written. One block needs no join. Every hash hit is verified word by word. What must fit besides is one window.

Defined results: NULL and empty texts have no words and are clean; items without words match
nothing; items with equal texts all count; NULL item ids take part as the empty string;
repeated documents give repeated rows; an empty benchmark leaves all clean; other columns pass
through ``decontaminate`` untouched and are ignored by ``contamination``.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwork.llm.common import chunks, long_array, small_side, stored, text_buffers
from tabwork.llm.text import ALPHANUMERIC, Words, windows, words

_SLOTS = 1 << 20


class Windows:
    """Windows of benchmark items by length: sorted hashes, their spelling, and the items that hold each."""

    def __init__(self, rows: list[tuple[int, int, bytes, str]]):
        found: dict[int, dict[int, tuple[bytes, set[str]]]] = {}
        for n, h, spelled, item in rows:
            found.setdefault(n, {}).setdefault(h & (1 << 64) - 1, (bytes(spelled), set()))[1].add(item)
        self.by_length = []
        for n, by in sorted(found.items()):
            order = sorted(by)
            slots = np.zeros(_SLOTS, bool)
            keys = np.array(order, np.uint64)
            slots[(keys & np.uint64(_SLOTS - 1)).astype(np.int64)] = True
            self.by_length.append((n, keys, slots, [by[h][0] for h in order], [sorted(by[h][1]) for h in order]))

    def hits(self, w: Words) -> Iterator[tuple[int, int, list[str]]]:
        """First word, length and items of each verified occurrence."""
        for n, keys, slots, spelled, items in self.by_length:
            at, hashes = windows(w, n)
            near = np.flatnonzero(slots[(hashes & np.uint64(_SLOTS - 1)).astype(np.int64)])
            place = np.minimum(np.searchsorted(keys, hashes[near]), len(keys) - 1)
            for i, k in zip(at[near].tolist(), np.where(keys[place] == hashes[near], place, -1).tolist()):
                if k >= 0 and w.spelled(i, n) == spelled[k]:
                    yield i, n, items[k]


def _item_windows(length: int):
    """The distinct windows (n, hash, spelled, item) of each item, n words each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for item, lo, hi in zip(batch.column(0).to_pylist(), offsets[:-1], offsets[1:]):
                w = words(data, np.array([lo, hi]), ALPHANUMERIC)
                n = min(length, len(w.starts))
                if not n:
                    continue
                at, hashes = windows(w, n)
                hashes, first = np.unique(hashes, return_index=True)
                for a in range(0, len(hashes), 10_000):
                    part = [w.spelled(int(i), n) for i in at[first[a : a + 10_000]]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), n, np.int32)), long_array(hashes[a : a + 10_000]), pa.array(part, pa.binary()), pa.array([item] * len(part), pa.string())], names=["n", "hash", "spelled", "item"])

    return run


def _tables(benchmark: DataFrame, window: int, max_chars: int) -> Iterator[tuple[int, Windows]]:
    """Window tables of blocks with about ``max_chars`` characters of spelled windows each, with their number. A table is made when it is asked for."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    made = stored(benchmark.sparkSession, items.mapInArrow(_item_windows(window), "n int, hash long, spelled binary, item string").distinct(), "windows")
    size = made.agg(F.sum(F.octet_length("spelled") + F.octet_length("item"))).first()[0] or 0
    blocks = size // max_chars + 1
    for block in range(blocks):
        yield blocks, Windows([tuple(r) for r in made.where(F.pmod(F.xxhash64("hash", "item"), F.lit(blocks)) == block).collect()])


_HITS = "n_words long, n_hit long, hit_spans array<int>, items array<string>"


def _scan(docs: DataFrame, table: Windows | None, first: str, kind: str, only_hits: bool) -> DataFrame:
    """The column ``first`` of ``docs``, of type ``kind``, with number of words, hit words, their spans, and items found in ``text``."""
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for lo, hi in chunks(offsets):
                w = words(data, offsets[lo : hi + 1], ALPHANUMERIC)
                hit, owner, items = np.zeros(len(w.starts), bool), w.owner(), [set() for _ in range(hi - lo)]
                for i, n, which in sent.value.hits(w) if sent.value else ():
                    hit[i : i + n] = True
                    items[owner[i]].update(which)
                sums = np.concatenate([[0], np.cumsum(hit)])
                n_hit = sums[w.first + w.counts] - sums[w.first]
                spans = [_runs(hit[f : f + n]) if h else [] for f, n, h in zip(w.first, w.counts, n_hit)]
                rows = pa.RecordBatch.from_arrays(
                    [batch.column(first).slice(lo, hi - lo), pa.array(w.counts.astype(np.int64)), pa.array(n_hit.astype(np.int64)),
                     pa.array(spans, pa.list_(pa.int32())), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                    names=[first, "n_words", "n_hit", "hit_spans", "items"])
                yield rows.filter(pa.array(n_hit > 0)) if only_hits else rows

    return docs.mapInArrow(run, f"{first} {kind}, {_HITS}")


def _in_blocks(docs: DataFrame, tables: Iterator[tuple[int, Windows]]) -> DataFrame:
    """As ``_scan`` of one table that holds all of ``tables``; a text has one row of hits a table at most."""
    spark, found, key = docs.sparkSession, None, F.sha2("text", 256)
    for _, table in tables:
        hits = _scan(docs.select(key.alias("digest"), "text"), table, "digest", "string", True)
        hits = stored(spark, hits.dropDuplicates(["digest"]).select("digest", "hit_spans", "items"), "hits")
        found = hits if found is None else found.unionByName(hits)
    each = found.groupBy("digest").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("found"), F.collect_list("hit_spans").alias("parts"))
    merged = stored(spark, each.mapInArrow(_merged, "digest string, found array<string>, hit_spans array<int>, n_hit long"), "hits")
    counted = _scan(docs.select(F.struct("kept", key.alias("digest")).alias("row"), "text"), None, "row", f"struct<kept:{docs.schema['kept'].dataType.simpleString()},digest:string>", False)
    wide = small_side(merged, 100, 4 * F.size("hit_spans") + F.octet_length(F.array_join("found", ",")) + 16 * F.size("found"))
    joined = counted.select("row.kept", F.col("row.digest").alias("digest"), "n_words").join(wide, "digest", "left")
    return joined.select(
        "kept", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("hit_spans", F.array().cast("array<int>")).alias("hit_spans"),
        F.coalesce("found", F.array().cast("array<string>")).alias("items"))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of several tables as the runs of their union."""
    for batch in batches:
        spans, counts = [], []
        for parts in batch.column("parts").to_pylist():
            hit = np.zeros(max(p[-1] for p in parts), bool)
            for p in parts:
                for a, b in zip(p[::2], p[1::2]):
                    hit[a:b] = True
            spans.append(_runs(hit))
            counts.append(int(hit.sum()))
        yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("found"), pa.array(spans, pa.list_(pa.int32())), pa.array(counts, pa.int64())], names=["digest", "found", "hit_spans", "n_hit"])


def _runs(flags: np.ndarray) -> list[int]:
    """Starts and ends of the runs of True, one after the other."""
    return np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]))).tolist()


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, max_chars: int = 50_000_000, keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Per document the columns ``keep`` and: words, words inside any occurrence of a benchmark window, items found, verdict.

    A document is contaminated if something was hit and ``share * n_hit >= n_words``. ``hit_spans``
    holds starts and ends, in words, of the runs of hit words.
    """
    rows = docs.select(F.struct(*keep).alias("kept"), F.coalesce("text", F.lit("")).alias("text"))
    tables = _tables(benchmark, window, max_chars)
    blocks, table = next(tables)
    found = _scan(rows, table, "kept", rows.schema["kept"].dataType.simpleString(), False) if blocks == 1 else _in_blocks(rows, chain([(blocks, table)], tables))
    return found.select(
        "kept.*", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "hit_spans", "items",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, spans: bool = False, **how) -> DataFrame:
    """The documents that are not contaminated, with all their columns; or all, with the contaminated words cut out of ``text``.

    Cutting leaves the other words of a contaminated document, lower-cased as they were compared, joined by spaces.
    """
    marked = contamination(docs.select(F.struct("*").alias("row"), "text"), benchmark, keep=("row",), **how)
    if not spans:
        return marked.where(~F.col("contaminated")).select("row.*")
    lowered = F.translate(F.coalesce("row.text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    pieces = F.filter(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda x: x != "")
    inside = lambda i: F.exists(F.sequence(F.lit(0), F.floor(F.size("hit_spans") / 2).cast("int") - 1), lambda k: (F.col("hit_spans")[k * 2] <= i) & (i < F.col("hit_spans")[k * 2 + 1]))
    rest = F.array_join(F.filter(pieces, lambda x, i: ~inside(i)), " ")
    return marked.withColumn("text", F.when(F.col("contaminated"), rest).otherwise(F.col("row.text"))).select(
        *[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    )
