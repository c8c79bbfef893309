"""Suffix-array dedup with sparse suffixes: passages of ``min_words`` words or more that occur more than once.

Words are runs of non-space bytes with A-Z lower-cased. Suffixes are kept only at minimisers: of
every ``window`` successive seeds (runs of ``seed`` words) the one with the least hash, which depends
on the content alone. With window + seed - 1 <= min_words, every copy of a long enough passage
keeps the suffix at the same place of it. Seeds that occur once go. The kept suffixes are brought into
the order of the seed and then of the words behind it, neighbours are compared, and the match is
extended to the right and to the left; the part that exceeds ``min_words`` with either neighbour
is a repeated span.

The longest match of a suffix on both sides together need not be with a neighbour in the order of what
stands on the right. So suffixes of one seed, where there are more than two, are also
grouped by the hash of each window of ``min_words`` words around the seed: suffixes in the same
group repeat that window. This makes the result exact: every word of every repeated
passage of ``min_words`` words is in a span. A seed of more than ``held`` suffixes is read in blocks:
windows that repeat within a block are spans at once, and those that do not, with one of each that does, go
to a second grouping by hash over all blocks.

Spans of a document that overlap or touch are joined. Hashes of words have 64 bits, and those of contexts 32;
a span rests on ``min_words`` equal word hashes in a row.

Defined results: NULL and empty texts have no spans; a repetition within one document counts as any
other; rows that share id and text are copies; different texts of one id, or of NULL, are
documents of their own, each with its spans; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwork.llm.common import blobs, chunks, long_array, small_side, stored, text_buffers
from tabwork.llm.text import NOT_SPACE, Words, constants, mix, windows, words

MIN_WORDS, SEED = 50, 26
#: What a document is known by: its id and a digest of its text.
_DOC = "doc struct<doc_id:bigint,digest:bigint>"
HELD = 32768


def _minimisers(w: Words, seed: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word within the text, and hash of the seeds that are least in some window of successive seeds; ties to the left."""
    at, hashes = windows(w, seed, seed=5)
    owner = w.owner()[at] if len(at) else np.empty(0, np.int64)
    if len(at) < 1:
        return owner, at, hashes
    # Runs of seeds of one text; a text with fewer seeds than a window has one window of them all.
    n = len(at)
    chosen = np.zeros(n, bool)
    first = np.searchsorted(owner, owner, "left")
    last = np.searchsorted(owner, owner, "right")
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate([hashes, np.full(window - 1, np.iinfo(np.uint64).max, np.uint64)]), window)
    for lo in range(0, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        inside = np.arange(lo, hi) + window <= last[lo:hi]
        best = np.arange(lo, hi) + view[lo:hi].argmin(axis=1)
        chosen[best[inside]] = True
    short = np.flatnonzero((first == np.arange(n)) & (last - first < window))
    for i in short:
        chosen[i + int(hashes[i : last[i]].argmin())] = True
    pick = np.flatnonzero(chosen)
    return owner[pick], at[pick] - w.first[owner[pick]], hashes[pick]


def _seed_rows(seed: int, window: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for lo, hi in chunks(offsets):
                w = words(data, offsets[lo : hi + 1], NOT_SPACE)
                owner, at, hashes = _minimisers(w, seed, window)
                long = w.counts[owner] >= min_words
                owner, at, hashes = owner[long], at[long], hashes[long]
                ids = batch.column(0).slice(lo, hi - lo)
                # A seed that is met twice here is known to repeat; one of it stands for all in the grouping.
                _, once, inverse, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
                again = np.flatnonzero(counts[inverse] > 1)
                for places, known in ((again, True), (once, False)):
                    columns = [ids.take(pa.array(owner[places])), pa.array(at[places].astype(np.int32)), long_array(hashes[places]), pa.array(np.full(len(places), known))]
                    yield pa.RecordBatch.from_arrays(columns, names=["document", "word", "seed", "known"])

    return run


def _suffix_rows(min_words: int, seed: int):
    """For the kept places of each document: the seed, and hashes of the words before and behind, 0 beyond the text."""
    left, right = min_words - seed, 2 * min_words - seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            places = batch.column(2)
            for lo, hi in chunks(offsets):
                w = words(data, offsets[lo : hi + 1], NOT_SPACE)
                short = ((mix(w.hashes) >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)
                lists = places.slice(lo, hi - lo)
                counts = np.array(pa.compute.list_value_length(lists).to_pylist(), np.int64)
                at = lists.flatten().to_numpy().astype(np.int64)
                owner = np.repeat(np.arange(hi - lo), counts)
                seed_at, seed_hash = windows(w, seed, seed=5)
                # Documents of one 64-bit number share their places: those that are none of this text go.
                own = at + seed <= w.counts[owner]
                at, owner = at[own], owner[own]
                base, stop = w.first[owner], (w.first + w.counts)[owner]
                hashes = seed_hash[np.searchsorted(seed_at, base + at)]
                for a in range(0, len(at), 8192):
                    part = slice(a, a + 8192)
                    word = (base + at)[part, None] + np.arange(-left, right)
                    inside = (word >= base[part, None]) & (word < stop[part, None])
                    context = np.where(inside, short[np.clip(word, 0, len(short) - 1)], 0).astype(">u4")
                    # What stands behind the seed comes first, so that the order of the bytes is the order of the suffixes.
                    context = np.concatenate([context[:, left:], context[:, :left]], axis=1)
                    rows = np.arange(len(context) + 1) * context.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(lo, hi - lo).take(pa.array(owner[part])), pa.array(at[part].astype(np.int32)), long_array(hashes[part]), blobs(context.ravel(), rows)],
                        names=["doc", "word", "seed", "context"])

    return run


def _codes(doc: pa.Array) -> np.ndarray:
    """A number for each document of a column of (id, digest)."""
    ids, digests = (column.dictionary_encode().indices.fill_null(-1).to_numpy().astype(np.int64) + 1 for column in doc.flatten())
    return ids * (len(doc) + 1) + digests


def _matches(min_words: int, seed: int, held: int):
    """Reads suffixes in order and gives spans (key NULL), or the windows of seeds with too many suffixes (key is the window's hash)."""
    left, right = min_words - seed, 2 * min_words - seed
    factors = constants(min_words, 601)

    def split(context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return context[:, :right], context[:, right:][:, ::-1]  # behind the seed; before it, from the seed outwards

    def window_hashes(context: np.ndarray) -> np.ndarray:
        """Hash of the window that starts each of 0..left words before the seed; 0 where the text ends within."""
        line = np.concatenate([context[:, right:], context[:, :right]], axis=1).astype(np.uint64)
        out = np.zeros((len(line), left + 1), np.uint64)
        for start in range(left + 1):
            for j in range(min_words):
                out[:, start] += line[:, start + j] * factors[j]
            out[:, start] = np.where((line[:, start : start + min_words] > 0).all(axis=1), mix(out[:, start]) | np.uint64(1), 0)
        return out

    def block(rows: list, parted: bool) -> Iterator[pa.RecordBatch]:
        """Spans of complete groups of suffixes; ``parted``: of a part of one group, with the windows the other parts must see."""
        doc, word, seeds, context = rows
        n, code = len(word), _codes(doc)
        behind, before = split(context)
        same = seeds[1:] == seeds[:-1]

        def run_length(x: np.ndarray) -> np.ndarray:
            differ = (x[1:] != x[:-1]) | (x[1:] == 0)
            return np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])

        r, l = run_length(behind), run_length(before)
        hit = np.flatnonzero(same & (r + l >= min_words))
        index = np.concatenate([hit, hit + 1])  # a match is a span of both neighbours
        at, stop = word[index] - np.tile(l[hit], 2), word[index] + np.tile(r[hit], 2)
        edges = np.flatnonzero(np.concatenate([[True], ~same]))
        sizes = np.diff(np.append(edges, n))
        many = np.flatnonzero(np.repeat((sizes > 2) | parted, sizes))
        if len(many):
            group = np.repeat(np.arange(len(edges)), sizes)[many].astype(np.uint64)
            hashes = window_hashes(context[many])
            row, start = np.nonzero(hashes)
            i, key = many[row], hashes[row, start]
            mine, place = mix(key ^ (group[row] * factors[0])), word[i] - left + start
            # Suffixes that stand in one window of one document are one occurrence of it.
            once = np.unique(np.stack([mine.view(np.int64), code[i], place]), axis=1, return_index=True)[1]
            i, place, key = i[once], place[once], key[once]
            _, first, inverse, counts = np.unique(mine[once], return_index=True, return_inverse=True, return_counts=True)
            again = counts[inverse] > 1
            index, at, stop = np.concatenate([index, i[again]]), np.concatenate([at, place[again]]), np.concatenate([stop, place[again] + min_words])
            if parted:
                for lo in range(0, len(first), 50_000):
                    j = first[lo : lo + 50_000]
                    yield spans(doc, i[j], place[j], place[j] + min_words, long_array(key[j]))
        if len(index):
            order = np.lexsort((at, code[index]))
            index, at, stop = index[order], at[order], stop[order]
            # Spans that overlap or touch become one; documents are kept apart by an offset larger than any place.
            offset = (code[index] + 1) * (int(stop.max()) + min_words + 2)
            upto = np.maximum.accumulate(stop + offset)
            new = np.flatnonzero(np.concatenate([[True], (at + offset)[1:] > upto[:-1]]))
            ends = upto[np.append(new[1:] - 1, len(upto) - 1)] - offset[new]
            yield spans(doc, index[new], at[new], ends, pa.nulls(len(new), pa.int64()))

    def spans(doc: pa.Array, index: np.ndarray, start: np.ndarray, stop: np.ndarray, key: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([doc.take(pa.array(index)), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)), key], names=["doc", "start", "stop", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, frequent = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            data, _ = text_buffers(batch.column(3))
            rows = [batch.column(0), batch.column(1).to_numpy().astype(np.int64), batch.column(2).to_numpy(), data.view(">u4").reshape(batch.num_rows, left + right)]
            if carry is not None:
                rows = [pa.concat_arrays([carry[0], rows[0]]), *(np.concatenate([c, r]) for c, r in zip(carry[1:], rows[1:]))]
            seeds = rows[2]
            cut = lambda a, b: [rows[0].slice(a, b - a), *(r[a:b] for r in rows[1:])]
            first = int(np.searchsorted(seeds, seeds[0], "right")) if seeds[0] == frequent else 0
            if first:
                yield from block(cut(0, first), True)
            last = int(np.searchsorted(seeds, seeds[-1], "left"))
            carry = None
            if last < first:
                continue
            if last > first:
                yield from block(cut(first, last), False)
            if len(seeds) - last > held:
                frequent = seeds[-1]
                yield from block(cut(last, len(seeds)), True)
            else:
                frequent, carry = None, cut(last, len(seeds))
        if carry is not None:
            yield from block(carry, False)

    return run


def _joined(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans of each document as one."""
    before = Window.partitionBy("doc").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    marked = spans.withColumn("new", F.coalesce(F.col("start") > F.max("stop").over(before), F.lit(True)).cast("int"))
    numbered = marked.withColumn("span", F.sum("new").over(Window.partitionBy("doc").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("doc", "span").agg(F.min("start").alias("start_word"), F.max("stop").alias("end_word")).drop("span")


def _doc() -> Column:
    return F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest")).alias("doc")


def _number() -> Column:
    """One 64-bit number for the id and text of a document, which keeps the table of places narrow."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text").alias("document")


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, seed: int = SEED, held: int = HELD) -> DataFrame:
    """Rows (doc_id, start_word, end_word) of the joined spans of words that occur more than once within a passage of ``min_words`` or more."""
    window = min_words - seed + 1
    if not 0 < seed <= min_words:
        raise ValueError("a seed has at least one word and at most min_words")
    spark = docs.sparkSession
    seeds = docs.select(_number(), "text").mapInArrow(_seed_rows(seed, window, min_words), "document long, word int, seed long, known boolean")
    beside = Window.partitionBy("seed").orderBy("document", "word")
    seeds = stored(spark, seeds, "seeds")
    kept = seeds.where("NOT known").withColumn("again", F.lag("word").over(beside).isNotNull() | F.lead("word").over(beside).isNotNull()).where("again")
    kept = kept.select("document", "word").unionByName(seeds.where("known").select("document", "word"))
    places = stored(spark, kept.groupBy("document").agg(F.array_sort(F.collect_set("word")).alias("places")), "places")
    on = docs.select(_doc(), _number(), "text").join(small_side(places, 80, 5 * F.size("places")), "document")
    suffixes = on.select("doc", "text", "places").mapInArrow(_suffix_rows(min_words, seed), f"{_DOC}, word int, seed long, context binary")
    ordered = suffixes.repartition("seed").sortWithinPartitions("seed", "context")
    found = stored(spark, ordered.mapInArrow(_matches(min_words, seed, held), f"{_DOC}, start int, stop int, key long"), "spans")
    frequent = found.where("key IS NOT NULL").distinct()
    again = frequent.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    more = frequent.join(again, "key", "left_semi").select("doc", "start", "stop")
    spans = _joined(found.where("key IS NULL").select("doc", "start", "stop").unionByName(more).distinct())
    return spans.select("doc.doc_id", "start_word", "end_word")
