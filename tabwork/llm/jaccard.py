"""Exact Jaccard join of word-shingle sets, size-aware and heavy-light, and the groups its links form.

Documents with equal sets are one node. A pair of sets of n and m shingles links if it shares
c(n, m) = ceil(t * (n + m) / (1 + t)) of them. Nodes meet in lists:

* Small sets, of at most ``boundary`` shingles, list themselves under every subset of c(n, m) of
  their shingles, for each partner size m up to the boundary.
* Larger sets (and the small ones that may have a larger partner) list themselves under their
  first n - ceil(t * n) + 1 shingles in one order of all shingles, so two linked sets share a list.
  The order is that of the hash, but frequent shingles come last, the rarer ones of them first: those that are, in some batch of
  documents, in ``FREQUENT`` of the sets. Any order gives the same links.
* The boundary is the size with the least cost: subsets to write, against list entries times the mean
  length of the lists, both from a count of all sets by size.

Most entries stand beside sets that they cannot link with, by size and place: those of lists of up to ``LIGHT`` entries go before
anything is written. Lists are dealt by key once for each round, whatever their number.

Lists are worked off so that a group of near copies costs about as many pairs as it has nodes:

* Rounds: each node is compared with one node only, the one that stands first in most of its lists; the links found so far make
  components, lists that lie within one component are dropped, and the rest goes into the next round,
  where the node compared with is one of another component. ``ROUNDS`` rounds at most.
* Lists of up to ``light`` nodes that still hold several components are compared in pairs of different components.
* Longer ones are compared in blocks of ``BLOCK`` nodes against each other, by bitmap, and only pairs that pass are written: at
  first only the nearest one of another component for each node, again and again while such pairs link, and what then still lies
  apart in full.
* The nodes of lists longer than ``LONG``, where comparing costs more than listing anew, are listed anew before that: shingles are
  dealt by hash into more parts than two linked sets can differ in, so two linked sets agree in all shingles of one part at
  least, and a node lists itself under each of its parts. These lists are compared in blocks in the same way.

A pair is looked at in a list only if the shingles from the listed one on suffice in both sets, as in the list of its first
common shingle they must. Each set has a bitmap of the parities of its hashed shingles, and two of them differ in no more
bits than the sets differ in shingles: bitmaps are compared before the sets of a pair are fetched. As a bitmap of fewer bits than
shingles tells nothing, larger sets have a wide one besides, of as many bits as shingles, that is folded to the length of the other's.
Bitmaps, and then sets, meet at the second node of a pair, dealt there by one shuffle; a node of many pairs is copied to one place for every ``AT_ONCE`` of them.

Components are exact: only pairs that could not change a component are left out. What stays quadratic is the comparing of bitmaps, not the
rows written, in lists of ``LONG`` nodes and in those of parts of many sets that agree in a part and do not link. Shingles are 64-bit hashes;
sets are compared by them in full.

Defined results: NULL and empty texts, and texts without words, have an empty set and are linked
with nothing; a text of fewer words than a shingle has its whole sequence as one; rows that share
id and text are copies; NULL ids have a count and no component; an empty table gives no rows; other
columns pass through ``keep_first`` untouched and are ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwork.llm.common import blobs, chunks, free_name, gathered, long_array, sent_if, small_side, stored, text_buffers
from tabwork.llm.graph import components
from tabwork.llm.text import NOT_SPACE, constants, mix, sets, shingles, words

#: Similarity as a fraction.
TOP, BOTTOM = 4, 5
SHINGLE = 5
#: Largest boundary considered between small and large sets.
MOST_SMALL = 32
#: Longest list of the first kind that is compared in pairs.
LIGHT = 32
#: Rounds of comparing each node with one other, and nodes of a long list that one task compares with as many others.
ROUNDS, BLOCK = 2, 1024
#: Longest list whose nodes are not listed anew by parts: links do not depend on it. A set of n shingles has about n / 4 parts, each a row, so listing anew pays for long lists only.
LONG = 4 * BLOCK
#: Passes over blocks at most in which a node is compared with the nearest one of another component only; what then remains is compared in full.
NEAREST = 8
#: Share of the sets of a batch that makes a shingle frequent, and the sets it takes at least.
FREQUENT, FEWEST = 0.0005, 5
#: Frequent shingles that are put last, and so sent to the tasks, at most: the most frequent ones. Others keep their place by hash; links do not depend on it.
MOST_FREQUENT = 1_000_000
_SALT = constants(4, 99)
#: Bits of the bitmap of a set.
BITS = 2048
#: Bits of the folded one, that is compared before a pair is written.
FOLDED = 512
#: Pairs of one node that are compared at one place.
AT_ONCE = 256
#: Pairs whose bitmaps or sets are worth a task.
PAIRS_A_TASK = 1000


def shared_needed(n: int, m: int) -> int:
    """Shingles that sets of n and m must share."""
    return -(-TOP * (n + m) // (TOP + BOTTOM))


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - (TOP * n + BOTTOM - 1) // BOTTOM + 1


def _fits(n: str, m: str):
    return (TOP * F.col(n) <= BOTTOM * F.col(m)) & (TOP * F.col(m) <= BOTTOM * F.col(n))


def _sets_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Row range, distinct shingles in order, where each text's start, and the node of each text (0 for empty sets)."""
    data, offsets = text_buffers(column)
    for lo, hi in chunks(offsets):
        owner, hashes = shingles(words(data, offsets[lo : hi + 1], NOT_SPACE), SHINGLE)
        values, starts = sets(owner, hashes, hi - lo)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values ^ _SALT[0]), out=sums[1:])
        sizes = np.diff(starts)
        nodes = mix(sums[starts[1:]] - sums[starts[:-1]] + sizes.astype(np.uint64) * _SALT[1])
        yield lo, hi, values, starts, np.where(sizes > 0, nodes, np.uint64(0))


def _digest() -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def document_nodes(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, digest, n_shingles, node, first, bits, folded, wide): the node is NULL for empty sets, ``first`` is the least shingle. Other rows hold frequent shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, none = ["doc_id", "digest", "n_shingles", "node", "first", "frequent", "bits", "folded", "wide"], lambda n: pa.nulls(n, pa.int64())
        for batch in batches:
            tokens, distinct, seen = [], 0, np.empty(0, np.uint64)
            for lo, hi, values, starts, nodes in _sets_of(batch.column(1)):
                sizes = np.diff(starts)
                first = np.append(values, np.uint64(0))[np.minimum(starts[:-1], len(values))]
                node = pa.compute.if_else(pa.array(sizes == 0), pa.scalar(None, pa.int64()), long_array(nodes))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(sizes.astype(np.int64)), node, long_array(first), none(hi - lo), *_bitmaps(values, starts)], names=names)
                fresh = _fresh(nodes, sizes, seen)
                seen = np.union1d(seen, nodes[fresh])
                distinct += int(fresh.sum())
                tokens.append(values[np.repeat(fresh, sizes)])
            if tokens:
                found = np.sort(np.concatenate(tokens))
                fewest = max(FEWEST, int(FREQUENT * distinct))
                often = np.unique(found[: len(found) - fewest + 1][found[: len(found) - fewest + 1] == found[fewest - 1 :]]) if len(found) >= fewest else found[:0]
                yield pa.RecordBatch.from_arrays([none(len(often))] * 5 + [long_array(often)] + [pa.nulls(len(often), pa.binary())] * 3, names=names)

    return docs.select("doc_id", "text", _digest()).mapInArrow(run, "doc_id long, digest long, n_shingles long, node long, first long, frequent long, bits binary, folded binary, wide binary")


def _bitmaps(values: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Bitmaps of the sets, the same folded to ``FOLDED`` bits, and wide ones of sets of more shingles than ``BITS``."""
    rows = len(starts) - 1
    place = np.repeat(np.arange(rows), np.diff(starts)) * BITS + (values >> np.uint64(7)).astype(np.int64) % BITS
    bits = np.packbits((np.bincount(place, minlength=rows * BITS) & 1).astype(bool))
    folded = np.bitwise_xor.reduce(bits.reshape(rows, BITS // FOLDED, FOLDED // 8), axis=1).ravel()
    wide = [_wide(values[a:b]) if b - a > BITS else None for a, b in zip(starts[:-1], starts[1:])]
    return blobs(bits, np.arange(rows + 1) * (BITS // 8)), blobs(folded, np.arange(rows + 1) * (FOLDED // 8)), pa.array(wide, pa.binary())


def _wide(values: np.ndarray) -> bytes:
    """The bitmap of one large set: as many bits as the next power of two, so that the shorter of two is the longer one folded."""
    length = 1 << int(len(values) - 1).bit_length()
    place = (values >> np.uint64(7)).astype(np.int64) % length
    return np.packbits((np.bincount(place, minlength=length) & 1).astype(bool)).tobytes()


def _fresh(nodes: np.ndarray, sizes: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Marks one text of each node that is not empty and not seen before."""
    fresh = np.zeros(len(nodes), bool)
    fresh[np.unique(nodes, return_index=True)[1]] = True
    return fresh & (sizes > 0) & ~np.isin(nodes, seen)


def choose_boundary(sizes: list[tuple[int, int, int]]) -> int:
    """The size up to which sets count as small, from (size, sets, distinct first shingles) of sizes up to ``MOST_SMALL``."""
    by = {n: (count, count / max(1, firsts)) for n, count, firsts in sizes}
    best, least = 0, None
    for x in range(MOST_SMALL + 1):
        cost = 0.0
        for n, (count, length) in by.items():
            if n <= x:
                cost += count * sum(comb(n, shared_needed(n, m)) for m in range(1, x + 1) if TOP * n <= BOTTOM * m and TOP * m <= BOTTOM * n)
            if n > x or BOTTOM * n >= TOP * (x + 1):
                cost += count * int(prefix_length(np.int64(n))) * length
        if least is None or cost < least:
            best, least = x, cost
    return best


def _subset_keys(tokens: np.ndarray, boundary: int) -> list[int]:
    """Keys of all subsets a small set lists itself under."""
    n, keys = len(tokens), []
    spread = mix(tokens ^ _SALT[2])
    for m in range(1, boundary + 1):
        if TOP * n <= BOTTOM * m and TOP * m <= BOTTOM * n:
            family = np.full(1, min(n, m) * 1000 + max(n, m), np.uint64) * _SALT[3]
            picks = np.array(list(combinations(range(n), shared_needed(n, m))))
            keys.append(mix(spread[picks].sum(axis=1, dtype=np.uint64) + family))
    return keys


def _entries(boundary: int, frequent):
    """Entries (key, node, n, pos) of each batch: pos is the place of a listed shingle in the order of the set.

    ``frequent`` is the broadcast pair of the sorted frequent shingles and the rank of each in the order of all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, rank = frequent.value
        for batch in batches:
            seen = np.empty(0, np.uint64)
            for _, _, values, starts, nodes in _sets_of(batch.column(0)):
                sizes = np.diff(starts)
                fresh = _fresh(nodes, sizes, seen)
                seen = np.union1d(seen, nodes[fresh])
                owner_of = np.repeat(np.arange(len(sizes)), sizes)
                place = np.zeros(len(values), np.int64)
                if len(often):
                    at = np.minimum(np.searchsorted(often, values), len(often) - 1)
                    place = np.where(often[at] == values, rank[at] + 1, 0)
                order = np.lexsort((place, owner_of))  # keeps the order of hashes among equals
                take = np.where(fresh & (BOTTOM * sizes >= TOP * (boundary + 1)), prefix_length(sizes), 0)
                pos = np.arange(int(take.sum())) - np.repeat(np.cumsum(take) - take, take)
                owner = np.repeat(np.arange(len(nodes)), take)
                parts = [(values[order[pos + starts[:-1][owner]]], nodes[owner], sizes[owner], pos)]
                for i in np.flatnonzero(fresh & (sizes <= boundary)):
                    for found in _subset_keys(values[starts[i] : starts[i + 1]], boundary):
                        parts.append((found, np.full(len(found), nodes[i]), np.full(len(found), sizes[i]), np.zeros(len(found), np.int64)))
                yield from _entry_rows(*(np.concatenate(column) for column in zip(*parts)))

    return run


def _entry_rows(key, node, n, pos):
    for lo in range(0, len(key), 50_000):
        part = slice(lo, lo + 50_000)
        yield pa.RecordBatch.from_arrays([long_array(key[part]), long_array(node[part]), pa.array(n[part].astype(np.int32)), pa.array(pos[part].astype(np.int32))], names=["key", "node", "n", "pos"])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of two or more nodes from entries in the order (key, node), each entry with the first one of its list. Holds one row between batches."""
    names = ("key", "node", "n", "pos")
    last, first, waits = None, None, False
    for batch in batches:
        rows = np.stack([batch.column(x).to_numpy().astype(np.int64) for x in names])
        if not rows.shape[1]:
            continue
        before = np.concatenate([rows[:2, :1] - 1 if last is None else last[:2, None], rows[:2, :-1]], axis=1)
        rows = rows[:, (rows[0] != before[0]) | (rows[1] != before[1])]
        if not rows.shape[1]:
            continue
        if last is not None:  # the last entry stands before the batch, to be written if its list goes on
            rows = np.concatenate([last[:, None], rows], axis=1)
        heads = np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])
        at = np.flatnonzero(heads)
        lengths = np.diff(np.append(at, rows.shape[1]))
        firsts = rows[1:, at]
        if last is not None:
            firsts[:, 0] = first
        write = np.repeat(lengths > 1, lengths)
        if last is not None:
            write[0] &= waits
        of = np.repeat(firsts, lengths, axis=1)
        single = bool(lengths[-1] == 1) and (last is None or len(lengths) > 1)
        first, last, waits = of[:, -1], rows[:, -1], single
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[i, write].astype(t)) for i, t in enumerate((np.int64, np.int64, np.int32, np.int32))] + [pa.array(of[i, write].astype(t)) for i, t in enumerate((np.int64, np.int32, np.int32))],
            names=[*names, "first", "first_n", "first_pos"])


def _fitting(components: bool):
    """Drops the entries that can link with none of their list, or with none of another component of it, from lists that stand together.

    The first one of what is left becomes the first of the list. Lists longer than ``LIGHT`` stay as they are; of one that goes on in the next batch
    no more rows are held.
    """
    key, n, pos, component = 0, 2, 3, 7

    def kept(rows: np.ndarray, whole: np.ndarray) -> np.ndarray:
        heads = np.flatnonzero(np.concatenate([[True], rows[key, 1:] != rows[key, :-1]]))
        lengths = np.diff(np.append(heads, rows.shape[1]))
        keep = np.repeat(whole | (lengths > LIGHT), lengths)
        ends = np.repeat(heads + lengths, lengths)
        stays, left, d = keep.copy(), np.flatnonzero(~keep), 0
        while True:  # each row against the one that stands d rows on
            d += 1
            left = left[left + d < ends[left]]
            if not len(left):
                break
            fits = _possible(rows[n, left], rows[pos, left], rows[n, left + d], rows[pos, left + d])
            if components:
                fits &= rows[component, left] != rows[component, left + d]
            keep[left[fits]] = keep[left[fits] + d] = True
        rows, stays, of = rows[:, keep], stays[keep], np.repeat(np.arange(len(heads)), lengths)[keep]
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.empty(0, np.int64)
        first = np.repeat(first, np.diff(np.append(first, len(of))))
        sources = (1, 2, 3, component) if components else (1, 2, 3)
        for to, source in zip((4, 5, 6, 8), sources):
            rows[to] = np.where(stays, rows[to], rows[source, first])
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, passed, schema = None, None, None  # ``passed`` is the long list of which a part was written
        for batch in batches:
            if not batch.num_rows:
                continue
            more, schema = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns]), batch.schema
            rows = more if rows is None else np.concatenate([rows, more], axis=1)
            last = int(np.flatnonzero(np.concatenate([[True], rows[key, 1:] != rows[key, :-1]]))[-1])
            cut = rows.shape[1] if rows.shape[1] - last > LIGHT or rows[key, last] == passed else last
            yield from written(rows[:, :cut], passed, schema)
            if cut > last:
                passed = rows[key, last]
            rows = rows[:, cut:]
        if rows is not None:
            yield from written(rows, passed, schema)

    def written(rows: np.ndarray, passed, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if rows.shape[1]:
            heads = np.flatnonzero(np.concatenate([[True], rows[key, 1:] != rows[key, :-1]]))
            whole = np.zeros(len(heads), bool) if passed is None else rows[key, heads] == passed
            yield pa.RecordBatch.from_arrays([pa.array(x).cast(f.type) for x, f in zip(kept(rows, whole), schema)], names=schema.names)

    return run


def _light_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of different components that a list of bounded length, in the order (key, node), leaves possible."""
    names = ("key", "node", "n", "pos", "component")
    rows, bits = np.empty((len(names), 0), np.int64), np.empty((0, FOLDED // 8), np.uint8)

    def pairs(rows, bits):
        key, node, n, pos, component = rows
        for d in range(1, rows.shape[1]):
            same = key[d:] == key[:-d]
            if not same.any():
                break
            i = np.flatnonzero(same & (component[d:] != component[:-d]))
            i = i[_possible(n[i], pos[i], n[i + d], pos[i + d])]
            most = (n[i] + n[i + d]) * (BOTTOM - TOP) // (TOP + BOTTOM)
            i = i[np.bitwise_count(bits[i] ^ bits[i + d]).sum(axis=1, dtype=np.int64) <= most]
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[i + d])], names=["a", "b"])

    for batch in batches:
        if batch.num_rows:
            rows = np.concatenate([rows, np.stack([batch.column(x).to_numpy().astype(np.int64) for x in names])], axis=1)
            bits = np.concatenate([bits, text_buffers(batch.column("folded"))[0].reshape(batch.num_rows, -1)])
            cut = int(np.searchsorted(rows[0], rows[0, -1], "left"))
            yield from pairs(rows[:, :cut], bits[:cut])
            rows, bits = rows[:, cut:], bits[cut:]
    yield from pairs(rows, bits)


def _possible(n, pos, m, other):
    """Whether sets of n and m shingles can link if the first shingle they share stands at these places."""
    need = -(-TOP * (n + m) // (TOP + BOTTOM))
    return (TOP * n <= BOTTOM * m) & (TOP * m <= BOTTOM * n) & (n - pos >= need) & (m - other >= need)


def _block_pairs(nearest: bool):
    """Pairs (a, b, apart) of different components, with bitmaps near enough, from pairs of blocks in the order (key, low, high). Holds one batch and one pair of blocks.

    ``nearest`` gives each node only the nearest one of another component in the other block.
    """
    names = ("key", "low", "high", "own", "node", "n", "pos", "component")

    def compare(rows, bits):
        key, low, high, own, node, n, pos, component = rows
        heads = np.flatnonzero(np.concatenate([[True], (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)]))
        ends = np.repeat(np.append(heads[1:], len(key)), np.diff(np.append(heads, len(key))))
        least, nearest_one = np.full(len(key), BITS + 1), np.zeros(len(key), np.int64)
        left, d = np.arange(len(key)), 0
        while True:  # each row against the one that stands d rows on
            d += 1
            left = left[left + d < ends[left]]
            if not len(left):
                break
            i, j = left, left + d
            fits = (component[i] != component[j]) & ((low[i] == high[i]) | (own[i] != own[j])) & _possible(n[i], pos[i], n[j], pos[j])
            i, j = i[fits], j[fits]
            apart = np.concatenate([np.bitwise_count(bits[i[at : at + 4096]] ^ bits[j[at : at + 4096]]).sum(axis=1, dtype=np.int64) for at in range(0, max(1, len(i)), 4096)])
            near = apart <= (n[i] + n[j]) * (BOTTOM - TOP) // (TOP + BOTTOM)
            i, j, apart = i[near], j[near], apart[near]
            if not nearest:
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[j]), pa.array(apart)], names=["a", "b", "apart"])
                continue
            for x, y in ((i, j), (j, i)):
                closer = (apart < least[x]) | ((apart == least[x]) & (node[y] < nearest_one[x]))
                least[x[closer]], nearest_one[x[closer]] = apart[closer], node[y[closer]]
        found = np.flatnonzero(least <= BITS)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(node[found]), pa.array(nearest_one[found]), pa.array(least[found])], names=["a", "b", "apart"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, bits = np.empty((len(names), 0), np.int64), np.empty((0, BITS // 64), np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([rows, np.stack([batch.column(x).to_numpy().astype(np.int64) for x in names])], axis=1)
            bits = np.concatenate([bits, _blobs_of(batch.column("bits"), batch.num_rows)])
            heads = np.flatnonzero(np.concatenate([[True], (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)]))
            if heads[-1]:
                yield from compare(rows[:, : heads[-1]], bits[: heads[-1]])
            rows, bits = rows[:, heads[-1] :], bits[heads[-1] :]
        if rows.shape[1]:
            yield from compare(rows, bits)

    return run


def _blobs_of(column: pa.Array, rows: int) -> np.ndarray:
    """Bitmaps of one length as rows of 64-bit numbers."""
    data, starts = text_buffers(column)
    return data[starts[0] : starts[-1]].copy().view(np.uint64).reshape(rows, -1)


def _class_starts() -> np.ndarray:
    """Sizes at which size classes start; a linked pair is in one class or two adjacent ones."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, starts[-1] * BOTTOM // TOP))
    return np.array(starts)


_STARTS = _class_starts()


def _part_keys(tokens: np.ndarray) -> np.ndarray:
    """Keys of a set's parts: in the family of its own size class, and in that of the next as the smaller partner."""
    own = int(np.searchsorted(_STARTS, len(tokens), "right")) - 1
    spread, dealt, keys = mix(tokens ^ _SALT[2]), mix(tokens ^ _SALT[3]) >> np.uint64(11), []
    for family in (own, own + 1):
        differ = 2 * (int(_STARTS[family + 1]) - 1) * (BOTTOM - TOP) // (TOP + BOTTOM)
        parts = differ + differ // 8 + 3
        part = (dealt % np.uint64(parts)).astype(np.int64)
        sums = np.zeros(parts, np.uint64)
        np.add.at(sums, part, spread)
        filled = np.bincount(part, minlength=parts) > 0
        if filled.sum() <= differ:
            filled[:] = True
        at = np.flatnonzero(filled)
        keys.append(mix(sums[at] + at.astype(np.uint64) * _SALT[0] + np.full(1, family, np.uint64) * _SALT[1]))
    return np.concatenate(keys)


def _fetch(docs: DataFrame, nodes: DataFrame, rows: int, known: DataFrame, body, schema: str) -> DataFrame:
    """Runs ``body`` over the text of one document of each of ``nodes``, of which there are at most ``rows``."""
    one = gathered(known.join(sent_if(nodes, rows, 8), "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "digest")).alias("one")), rows)
    ids = stored(docs.sparkSession, gathered(one.select("one.doc_id", "one.digest").distinct(), rows), "ids")
    return docs.select("doc_id", "text", _digest().alias("digest")).join(small_side(ids, 16), ["doc_id", "digest"], "left_semi").select("text").mapInArrow(body, schema)


def _part_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries (key, node, n, pos) of the parts; a part has no place in an order."""
    for batch in batches:
        for _, _, values, starts, nodes in _sets_of(batch.column(0)):
            keys = [_part_keys(values[a:b]) if b > a else np.empty(0, np.uint64) for a, b in zip(starts[:-1], starts[1:])]
            times = np.array([len(k) for k in keys])
            yield from _entry_rows(np.concatenate(keys), np.repeat(nodes, times), np.repeat(np.diff(starts), times), np.zeros(int(times.sum()), np.int64))


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen = np.empty(0, np.uint64)
        for _, _, values, starts, nodes in _sets_of(batch.column(0)):
            fresh = _fresh(nodes, np.diff(starts), seen)
            seen = np.union1d(seen, nodes[fresh])
            at = np.concatenate([[0], np.cumsum(np.diff(starts)[fresh])])
            yield pa.RecordBatch.from_arrays([long_array(nodes[fresh]), blobs(values[np.repeat(fresh, np.diff(starts))], at)], names=["node", "tokens"])


def _alike(hub: dict, other: dict) -> bool:
    """Whether two sets may link by their sizes and bitmaps."""
    n, m = hub["n_shingles"].as_py(), other["n_shingles"].as_py()
    kind = "wide" if hub["wide"].is_valid and other["wide"].is_valid else "bits"
    x, y = sorted((np.frombuffer(side[kind].as_buffer(), np.uint8) for side in (hub, other)), key=len)
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64)) <= (n + m) * (BOTTOM - TOP) // (TOP + BOTTOM)


def _linked(hub: dict, other: dict) -> bool:
    """Whether two sets link."""
    s, t = (np.frombuffer(side["tokens"].as_buffer(), np.uint64) for side in (hub, other))
    at = np.searchsorted(s, t)
    common = int((s[np.minimum(at, len(s) - 1)] == t).sum())
    return BOTTOM * common >= TOP * (len(s) + len(t) - common)


def _meet(rows: DataFrame, pairs: DataFrame, n: int, test) -> DataFrame:
    """The pairs (a, b) whose ``rows`` (node, ...) pass the test. ``pairs`` is stored and distinct, and has ``n`` rows at most.

    Rows are dealt to the second nodes of their pairs. There stands the row of that node itself, as often as it has ``AT_ONCE`` pairs.
    """
    spark = pairs.sparkSession
    most = stored(spark, gathered(pairs.groupBy("b").agg(F.ceil(F.count("*") / AT_ONCE).cast("int").alias("places")).where("places > 1"), n), "places")
    dealt = pairs.join(small_side(most, 12), "b", "left").select("a", "b", F.coalesce(F.pmod(F.xxhash64("a"), "places"), F.lit(0)).cast("int").alias("place"))
    hubs = gathered(dealt.select(F.col("b").alias("node"), "b", "place", F.lit(False).alias("partner")).distinct(), n)
    to = stored(spark, dealt.select(F.col("a").alias("node"), "b", "place", F.lit(True).alias("partner")).union(hubs), "to")
    met = gathered(rows.join(sent_if(to, 2 * n, 24), "node").repartition("b", "place"), n, PAIRS_A_TASK).sortWithinPartitions("b", "place", "partner", "node")
    values = [c for c in rows.columns if c != "node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, last = None, None
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in ("b", "place", "partner", "node"))))
            columns, found = [batch.column(c) for c in values], []
            for i, (b, place, partner, node) in enumerate(places):
                if (b, place, partner, node) == last:  # of a document that is there more than once
                    continue
                last = (b, place, partner, node)
                row = {name: column[i] for name, column in zip(values, columns)}
                if not partner:
                    hub = row
                elif test(hub, row):
                    found.append((node, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def _verify(docs: DataFrame, known: DataFrame, pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    spark = docs.sparkSession
    pairs = stored(spark, pairs.select("a", "b"), "pairs")
    pairs = stored(spark, _meet(bitmaps.select("node", "n_shingles", "bits", "wide"), pairs, pairs.count(), _alike), "alike")
    n = pairs.count()
    nodes = gathered(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), 2 * n)
    return _meet(_fetch(docs, nodes, 2 * n, known, _set_rows, "node long, tokens binary"), pairs, n, _linked)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


_LIST = "key long, node long, n int, pos int, first long, first_n int, first_pos int"


def _lists(entries: DataFrame) -> DataFrame:
    found = entries.repartition("key").sortWithinPartitions("key", "node").mapInArrow(lambda batches: _fitting(False)(_scan(batches)), _LIST)
    return stored(entries.sparkSession, found, "lists")


def _may_link(n: str, pos: str, m: str, other: str):
    need = F.ceil(TOP * (F.col(n) + F.col(m)) / (TOP + BOTTOM))
    return _fits(n, m) & (F.col(n) - F.col(pos) >= need) & (F.col(m) - F.col(other) >= need)


def _rounds(docs: DataFrame, known: DataFrame, lists: DataFrame, bitmaps: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """Rounds over the lists: the links found, and the lists that still hold several of the components they make, with component and length."""
    spark, tried, links, found = docs.sparkSession, None, None, None
    for _ in range(ROUNDS):
        if found is not None:
            lists = _several(spark, lists, found)
        rows = lists.count()
        apart = F.col("node") != F.col("first") if found is None else F.col("component") != F.col("beside")
        near = lists.where(apart).where(_may_link("n", "pos", "first_n", "first_pos"))
        # Of the nodes that stand first in its lists, a node is compared with the one that does so most often: alike sets share most lists.
        near = gathered(near.groupBy(F.col("node").alias("a"), F.col("first").alias("b")).agg(F.count("*").alias("times")), rows)
        near = near if tried is None else near.join(tried, ["a", "b"], "left_anti")
        fresh = stored(spark, gathered(_ordered(gathered(near.groupBy("a").agg(F.max(F.struct("times", "b"))["b"].alias("b")), rows)), rows), "pairs")
        if fresh.isEmpty():
            break
        both = fresh.unionByName(fresh.select(F.col("b").alias("a"), F.col("a").alias("b")))
        tried = both if tried is None else tried.unionByName(both)
        more = stored(spark, _verify(docs, known, fresh, bitmaps), "verified")
        if more.isEmpty():
            break
        links = more if links is None else links.unionByName(more)
        found = components(links)
    return links, _several(spark, lists, found)


_SEVERAL = f"{_LIST}, component long, beside long, length long"


def _several(spark, lists: DataFrame, found: DataFrame | None) -> DataFrame:
    """Entries of the lists that hold nodes of several components, with the one of least component and node as the first; lists are dealt by key once."""
    rows, n = lists.select("key", "node", "n", "pos"), lists.count()
    placed = rows.withColumn("component", F.col("node")) if found is None else rows.join(small_side(found, 16), "node", "left").select("key", "node", "n", "pos", F.coalesce("component", "node").alias("component"))
    of = Window.partitionBy("key")
    dealt = placed.repartition("key").sortWithinPartitions("key", "component", "node")
    seen = dealt.withColumns({"head": F.min(F.struct("component", "node", "n", "pos")).over(of), "high": F.max("component").over(of), "length": F.count("*").over(of)})
    held = seen.where(F.col("head.component") != F.col("high")).select(
        "key", "node", "n", "pos", F.col("head.node").alias("first"), F.col("head.n").alias("first_n"), F.col("head.pos").alias("first_pos"), "component", F.col("head.component").alias("beside"), "length",
    )
    return stored(spark, gathered(held, n).mapInArrow(_fitting(True), _SEVERAL), "several")


def _dealt_with(rows: DataFrame, bits: DataFrame, row_bytes: int, *keys: str) -> DataFrame:
    """``rows`` dealt and sorted by ``keys``, with the ``bits`` (node, ...) of their nodes: small ones are added after the shuffle."""
    side = small_side(bits, row_bytes)
    joined = rows.join(side, "node").repartition(*keys) if side is bits else rows.repartition(*keys).join(side, "node")
    return joined.sortWithinPartitions(*keys, "node")


def _in_blocks(lists: DataFrame, bits: DataFrame, nearest: bool) -> DataFrame:
    """Candidate pairs of long lists: each pair of blocks of a list is one group of rows, of bounded size."""
    blocks = F.ceil(F.col("length") / BLOCK).cast("int")
    cut = lists.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cut = cut.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "n", "pos", "component")
    pairs = _dealt_with(cut, bits, 8 + BITS // 8, "key", "low", "high").mapInArrow(_block_pairs(nearest), "a long, b long, apart long")
    if not nearest:
        return _ordered(pairs)
    rows = lists.count()
    return gathered(_ordered(gathered(pairs.groupBy("a").agg(F.min(F.struct("apart", "b"))["b"].alias("b")), rows)), rows)


def _long_links(docs: DataFrame, known: DataFrame, lists: DataFrame, bitmaps: DataFrame, links: DataFrame | None) -> DataFrame | None:
    """``links`` and those that long lists add to them."""
    spark = docs.sparkSession
    lists = _several(spark, lists, None if links is None else components(links))
    n = lists.count()
    nodes = gathered(lists.select("node").distinct(), n)
    bits = stored(spark, bitmaps.join(sent_if(nodes, n, 8), "node", "left_semi").select("node", "bits"), "bits")
    nearest, passes = True, 0
    while True:
        more = stored(spark, _verify(docs, known, _in_blocks(lists, bits, nearest), bitmaps), "verified")
        if not more.isEmpty():
            links = more if links is None else links.unionByName(more)
        if not nearest:
            return links
        # As long as nearest ones link, each pass joins every component that has a link to another one.
        passes += 1
        nearest = not more.isEmpty() and passes < NEAREST
        if not more.isEmpty():
            lists = _several(spark, lists, components(links))


def link_components(docs: DataFrame, known: DataFrame, frequent: DataFrame, light: int, longest: int) -> DataFrame:
    """Rows (node, component) of the nodes that link with another one. ``known`` and ``frequent`` are of ``document_nodes``."""
    spark = docs.sparkSession
    small = known.where(F.col("n_shingles").between(1, MOST_SMALL)).groupBy("n_shingles", "node").agg(F.first("first").alias("first"))
    sizes = small.groupBy("n_shingles").agg(F.count("*").alias("sets"), F.countDistinct("first").alias("firsts")).collect()
    boundary = choose_boundary([tuple(r) for r in sizes])
    by_count = np.array([r["frequent"] for r in frequent.collect()], np.int64).view(np.uint64)[::-1]
    order = np.argsort(by_count)
    sent = spark.sparkContext.broadcast((by_count[order], order))
    entries = docs.where(F.col("doc_id").isNotNull()).select("text").mapInArrow(_entries(boundary, sent), "key long, node long, n int, pos int")
    lists = _lists(entries)
    bitmaps = stored(spark, known.join(lists.select("node").distinct(), "node", "left_semi").select("node", "n_shingles", "bits", "folded", "wide").dropDuplicates(["node"]), "bitmaps")
    links, lists = _rounds(docs, known, lists, bitmaps)

    rest = lists.where(F.col("length") <= light).select("key", "node", "n", "pos", "component")
    rest = _dealt_with(rest, bitmaps.select("node", "folded"), 8 + FOLDED // 8, "key").mapInArrow(_light_pairs, "a long, b long")
    more = stored(spark, _verify(docs, known, _ordered(rest), bitmaps), "verified")
    if not more.isEmpty():
        links = more if links is None else links.unionByName(more)
    middle = lists.where(F.col("length").between(light + 1, longest))
    if not middle.isEmpty():
        links = _long_links(docs, known, middle, bitmaps, links)
    long = lists.where(F.col("length") > longest).select("node").distinct()
    if not long.isEmpty():
        links = _long_links(docs, known, _lists(_fetch(docs, long, long.count(), known, _part_entries, "key long, node long, n int, pos int")), bitmaps, links)
    return spark.createDataFrame([], "node long, component long") if links is None else components(links)


def document_groups(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, digest, n_shingles, group, component_id) of each row: groups are told apart by a number, empty sets have none."""
    spark = docs.sparkSession
    made = stored(spark, document_nodes(docs), "nodes")
    known = made.where("frequent IS NULL").drop("frequent")
    frequent = made.where("frequent IS NOT NULL").groupBy("frequent").count().orderBy(F.desc("count"), "frequent").select("frequent").limit(MOST_FREQUENT)
    nodes = known.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    found = link_components(docs, nodes, frequent, LIGHT, LONG)
    least = nodes.groupBy("node").agg(F.min("doc_id").alias("least")).join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    of = least.groupBy("component").agg(F.min("least").alias("component_id"))
    by_node = least.join(of, "component").select("node", F.col("component").alias("group"), "component_id")
    joined = known.select("doc_id", "digest", "n_shingles", "node").join(by_node, "node", "left")
    return joined.select("doc_id", "digest", "n_shingles", "group", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def groups(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id): the smallest id that links and copies reach."""
    return document_groups(docs).select("doc_id", "n_shingles", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group, one with the smallest id, with all its columns; rows with NULL ids all stay.

    Where an id has several texts, each that is in a group of its own stays: only repeats and near copies go.
    """
    id_name, text_name, group_name = (free_name(docs.columns, name) for name in ("kept_id", "kept_text", "kept_group"))
    firsts = document_groups(docs).where("doc_id = component_id").groupBy("doc_id", F.coalesce("group", "digest").alias(group_name)).agg(F.min("digest").alias(text_name))
    firsts = firsts.withColumnRenamed("doc_id", id_name)
    marked = docs.join(firsts, (docs["doc_id"] == firsts[id_name]) & (_digest() == firsts[text_name]))
    one = marked.dropDuplicates([id_name, group_name]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return one.unionByName(docs.where(F.col("doc_id").isNull()))
