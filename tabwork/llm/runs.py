"""Periodic runs of words, found with a suffix automaton and link-cut access, and texts with the repeats cut out.

A run is a stretch of words with smallest period q (words q apart are identical), of at least
``max(min_length, exponent * q)`` words, that no neighbouring word extends with period q.

* The suffix automaton of a stretch has a state for each class of factors that end at the same places;
  the suffix links make a tree, in which the path of a prefix holds all its suffixes.
* Words are appended one by one. An access walks from the state of the new prefix to the root and
  makes that path one preferred path, kept as a splay tree, in the colour of the new end. What it
  crosses are segments of older paths, each in the colour of the last end of its factors. A segment
  with factors of lengths lo + 1 .. hi that ended last at c says: distance d = i - c with lo < d <= hi
  is a square of two words of length d that ends at i, and d is primitive as the root has not
  ended since. A run of period d shows a square at every end from its second period on, so
  squares of one distance at consecutive ends make up the run. Accesses cross
  O(n log n) segments in all.

Before that, array work narrows a text to the stretches that can hold a run. Every factor of ``GRAM``
words of a run occurs ``times`` times in it, so stretches are cut wherever a factor occurs fewer times
in its stretch, again and again until nothing changes; no run is lost or shortened by it. The automaton
is built for what is left, one stretch at a time; its size follows the longest stretch of one
text (about 0.2 KB a word), never a group of texts. There is no shuffle: texts are handled where they are read.

Words are runs of bytes other than space and tab to carriage return, in their own case, and are told apart
by 64-bit hashes. Defined results: a NULL or empty text, or one without words, has no run, and its
collapsed text is empty; rows with equal or NULL ids are handled each on its own; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwork.llm.common import chunks, text_buffers
from tabwork.llm.text import NOT_SPACE, Words, mix, span_hashes, windows

#: Words of the factors by which stretches are narrowed.
GRAM = 3
#: Longer stretches keep their automaton in packed arrays, which are smaller and somewhat slower than lists.
PACKED = 100_000
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def suffix_automaton(word: list[int]) -> tuple:
    """Lengths and suffix links of the states, 0 being the root, and the state of each prefix.

    Nearly all states have one way on, kept in two arrays; further ones are in a dictionary.
    """
    keep = list if len(word) < PACKED else (lambda v: array("i", v))
    length, link, first, to, more, at = keep([0]), keep([0]), keep([-1]), keep([0]), {}, keep([])
    last = 0
    for i, c in enumerate(word):
        new, p, q = len(length), last, -1
        length.append(i + 1), link.append(0), first.append(-1), to.append(0), at.append(new)
        while True:
            if first[p] == c:
                q = to[p]
            elif first[p] < 0:
                first[p], to[p] = c, new
            else:
                ways = more.setdefault(p, {})
                q = ways.setdefault(c, new)
                q = -1 if q == new else q
            if q >= 0 or p == 0:
                break
            p = link[p]
        if q >= 0 and length[q] == length[p] + 1:
            link[new] = q
        elif q >= 0:
            copy = len(length)
            length.append(length[p] + 1), link.append(link[q]), first.append(first[q]), to.append(to[q])
            if q in more:
                more[copy] = dict(more[q])
            link[q] = link[new] = copy
            while True:
                if first[p] == c and to[p] == q:
                    to[p] = copy
                elif p in more and more[p].get(c) == q:
                    more[p][c] = copy
                else:
                    break
                if p == 0:
                    break
                p = link[p]
        last = new
    return length, link, at


def squares(word: list[int]) -> Iterator[tuple[int, int]]:
    """Ends and periods (end, d) of all primitive squares: word[end - 2d + 1 .. end] is twice the same, the root not a power."""
    length, above, at = suffix_automaton(word)
    left, right, colour = (length[:1] * len(length) for _ in range(3))
    for state in range(len(length)):
        colour[state] = -1

    def rotate(x, y, z):
        if left[y] == x:
            t = left[y] = right[x]
            right[x] = y
        else:
            t = right[y] = left[x]
            left[x] = y
        if t:
            above[t] = y
        above[y], above[x] = x, z
        if left[z] == y:
            left[z] = x
        elif right[z] == y:
            right[z] = x
        else:  # y was the root of its path, which carries the colour
            colour[x] = colour[y]

    for i, node in enumerate(at):
        below, seen, reach = 0, -1, 0
        while node:
            y = above[node]
            while left[y] == node or right[y] == node:
                z = above[y]
                if left[z] == y or right[z] == y:
                    if (left[z] == y) == (left[y] == node):
                        rotate(y, z, above[z])
                        rotate(node, y, above[y])
                    else:
                        rotate(node, y, z)
                        rotate(node, z, above[z])
                else:
                    rotate(node, y, z)
                y = above[node]
            here = length[node]
            if seen >= 0 and here < i - seen <= reach:
                yield i, i - seen
            seen, reach = colour[node], here
            rest = right[node]
            if rest:
                colour[rest] = seen
            right[node] = below
            below, node = node, y
        if seen >= 0 and 0 < i - seen <= reach:
            yield i, i - seen
        colour[below] = i


def stretch_runs(word: list[int], min_length: int, exponent: int) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of a stretch, by start and period."""
    found, latest, longest = [], {}, len(word) // exponent
    for end, d in squares(word):
        if d > longest:
            continue
        run = latest.get(d)
        if run is not None and run[1] == end - 1:
            run[1] = end
            continue
        start = end - 2 * d + 1
        while start > 0 and word[start - 1] == word[start - 1 + d]:
            start -= 1
        latest[d] = run = [start, end, d]
        found.append(run)
    return sorted((s, e - s + 1, d) for s, e, d in found if e - s + 1 >= max(min_length, exponent * d))


def _times(min_length: int, exponent: int) -> int:
    """How often each factor of ``GRAM`` words of a run occurs in it at least."""
    return min((max(min_length, exponent * q) - GRAM + 1) // q for q in range(1, min_length + GRAM + 1))


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    data = data[offsets[0] : offsets[-1]]
    texts = offsets[:-1] - offsets[0]
    edge = np.zeros(len(data) + 1, bool)
    inside = NOT_SPACE[data]
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[texts] = edge[-1] = True
    # Pieces between edges are all word or all gap.
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    word = inside[starts] if len(data) else np.zeros(0, bool)
    starts, ends = starts[word], ends[word]
    first = np.searchsorted(starts, texts)
    return Words(data, starts, ends, span_hashes(data, starts, ends), first, np.diff(np.append(first, len(starts))))


def _stretches(w: Words, min_length: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of the stretches that can hold a run, none of which crosses a text."""
    times = _times(min_length, exponent)
    at, grams = windows(w, GRAM)
    group = w.owner()[at].astype(np.uint64) if len(at) else np.empty(0, np.uint64)
    while True:
        keys = mix(grams ^ mix(group + np.uint64(1)))
        order = np.argsort(keys)
        ranked = keys[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.empty(0, bool)
        sizes = np.diff(np.append(np.flatnonzero(new), len(ranked)))
        often = np.empty(len(keys), bool)
        often[order] = np.repeat(sizes, sizes) >= times
        kept, grams_kept, group_kept = at[often], grams[often], group[often]
        head = np.concatenate([[True], (kept[1:] != kept[:-1] + 1) | (group_kept[1:] != group_kept[:-1])]) if len(kept) else np.empty(0, bool)
        starts = np.flatnonzero(head)
        lengths = np.diff(np.append(starts, len(kept)))
        enough = lengths >= min_length - GRAM + 1
        whole = np.repeat(enough, lengths)
        if often.all() and enough.all():
            return (kept[starts], lengths + GRAM - 1) if len(kept) else (np.empty(0, np.int64),) * 2
        at, grams = kept[whole], grams_kept[whole]
        group = np.repeat(np.arange(enough.sum(), dtype=np.uint64), lengths[enough])


def chunk_runs(w: Words, min_length: int, exponent: int) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """Texts with runs, and their runs in words of the text, by start and period."""
    owner, found = w.owner(), {}
    for start, length in zip(*(x.tolist() for x in _stretches(w, min_length, exponent))):
        word = np.unique(w.hashes[start : start + length], return_inverse=True)[1].tolist()
        text = int(owner[start])
        offset = start - int(w.first[text])
        found.setdefault(text, []).extend((s + offset, n, d) for s, n, d in stretch_runs(word, min_length, exponent))
    return ((text, sorted(runs)) for text, runs in found.items())


def _collapsed(w: Words, dropped: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of all texts, joined by single spaces, and where each text's start."""
    texts, kept = len(w.counts), np.flatnonzero(~dropped)
    owner = w.owner()[kept]
    inner = np.zeros(len(kept), np.int64)
    inner[:-1] = owner[1:] == owner[:-1]
    # A word that another one of its text follows has a gap behind it, whose first byte becomes the space.
    steps = np.zeros(len(w.data) + 2, np.int8)
    np.add.at(steps, w.starts[kept], 1)
    np.add.at(steps, w.ends[kept] + inner, -1)
    take = np.cumsum(steps[: len(w.data)], dtype=np.int8).astype(bool)
    data = w.data.copy()
    data[w.ends[kept[inner > 0]]] = 32
    sizes = np.bincount(owner, weights=(w.ends - w.starts)[kept] + inner, minlength=texts).astype(np.int64)
    return data[take], np.concatenate([[0], np.cumsum(sizes)])


def periodic_runs(docs: DataFrame, min_length: int = 6, exponent: int = 4) -> DataFrame:
    """Rows (doc_id, n_words, runs, collapsed): the runs by start and period, and the text without the words that a run
    repeats (a word is dropped if some run has it after its first period), kept words joined by one space."""
    if exponent < 2 or min_length < GRAM:
        raise ValueError(f"exponent must be 2 at least and min_length {GRAM}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for lo, hi in chunks(offsets):
                w = _words(data, offsets[lo : hi + 1])
                change, rows = np.zeros(len(w.starts) + 1, np.int32), [[] for _ in range(hi - lo)]
                for text, runs in chunk_runs(w, min_length, exponent):
                    rows[text] = [{"start": s, "length": n, "period": d} for s, n, d in runs]
                    for s, n, d in runs:
                        change[w.first[text] + s + d] += 1
                        change[w.first[text] + s + n] -= 1
                out, starts = _collapsed(w, np.cumsum(change[:-1]) > 0)
                text = pa.LargeStringArray.from_buffers(hi - lo, pa.py_buffer(starts.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes()))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).cast(pa.int64()), pa.array(w.counts.astype(np.int64)), pa.array(rows, kind), text.cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def highest_run(runs: str) -> Column:
    """Of an array of runs by start and period the one with the greatest length over period, the first of equals; NULL if there is none."""
    return F.aggregate(F.col(runs), F.get(F.col(runs), F.lit(0)), lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best))


def with_periodic_tail(docs: DataFrame) -> DataFrame:
    """Documents with id digest h = crc32 of the id as text: for h % 10 = 0 each word from a = g % n on, g = h div 10, is replaced
    so that the rest of the text has period 1 + (n - a) div (3 + g % 8). Texts without words stay, and so do NULL ids."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    due = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).cast("long").alias("g"))
    sized = due.withColumn("n", F.greatest(F.size("w"), F.lit(0)).cast("long")).withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END"))
    paced = sized.withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    again = "array_join(transform(sequence(0L, n - 1), i -> element_at(w, CAST(1 + IF(i < a, i, a + (i - a) % p) AS INT))), ' ')"
    return paced.select("doc_id", F.expr(f"CASE WHEN n > 0 THEN {again} ELSE text END").alias("text"))
