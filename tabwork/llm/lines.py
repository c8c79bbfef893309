"""Line dedup by a deletion-neighbourhood join.

Lines are what line feeds separate. A line goes if an earlier one (smaller document id, then
smaller line number) is equal to it, or within one edit of it: one character inserted, deleted or
replaced. Lines under ``min_chars`` characters only go when equal, as one edit says nothing there; blank
lines always stay.

Equal lines become one by 128-bit hashes, with their first place. Two lines within one edit agree in
their first or their last half, so lines list themselves under hashes of both; only lines that meet
another one there go on, with the half in which the edit must lie. They emit themselves and all
variants with one character of that half deleted, as hashed keys, and equal variants are joined: a
replaced character shows as the same variant with the same deleted place, an inserted one as a
variant equal to a whole line. Lines that meet an earlier one are verified by the edit distance
of the texts. Every group is read in a stream, so no group is held, whatever its size. Texts are joined
as single lines, by (doc_id, line); a side of a join is broadcast only if its bytes, texts counted in full, are few.

Defined results: NULL text stays NULL and empty text stays empty; in rows that share a document
id, lines of equal number and text stay in each; rows with NULL ids are untouched and
unseen by others; a document whose lines all go keeps an empty text; an empty table
gives no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tabwork.llm.common import chunks, free_name, long_array, small_side, stored, text_buffers
from tabwork.llm.text import constants, mix, powers, span_hashes

MIN_CHARS = 20
_SECOND = constants(256, 501)
_SALT = constants(4, 502)
#: Variants of lines that are put together for one batch.
_MOST = 100_000
_SPACES = np.isin(np.arange(256), [9, 11, 12, 13, 32])


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, number within the text, start and end of every line that is not blank."""
    texts, feeds = offsets[:-1], np.flatnonzero(data == 10)
    # A feed belongs to the last text that starts at or before it; empty texts start where the next one does.
    owner = np.concatenate([np.arange(len(texts)), np.searchsorted(texts, feeds, "right") - 1])
    starts = np.concatenate([texts, feeds + 1])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    ends = np.append(starts[1:] - 1, offsets[-1])
    last = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))
    ends[last] = offsets[1:][owner[last]]
    first = np.searchsorted(owner, owner)
    sums = np.concatenate([[0], np.cumsum(~_SPACES[data] & (data != 10))])
    shown = sums[ends] > sums[starts]
    number = np.arange(len(owner)) - first
    return owner[shown], number[shown], starts[shown], ends[shown]


def _line_rows(min_chars: int):
    """One row per line: place, two hashes, and hashes of halves as a shorter or equal partner and as the longer one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            ids = batch.column(0).to_numpy()
            for lo, hi in chunks(offsets):
                part, cuts = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                owner, number, starts, ends = _lines(part, cuts)
                # Halves are cut between characters: at the n-th byte that starts one.
                heads = np.flatnonzero((part & 0xC0) != 0x80)
                place = np.append(heads, len(part))
                a, b = np.searchsorted(heads, starts), np.searchsorted(heads, ends)
                length = b - a
                keys = []
                for half in (length // 2, np.maximum(length - 1, 0) // 2):
                    for side, (x, y) in enumerate(((starts, place[a + half]), (place[b - half], ends))):
                        keys.append(mix(span_hashes(part, x, y) ^ (half.astype(np.uint64) * _SALT[0] + _SALT[1 + side])))
                near = length >= min_chars
                same = length // 2 == np.maximum(length - 1, 0) // 2
                null = lambda k, mask: pa.compute.if_else(pa.array(mask), long_array(k), pa.scalar(None, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi][owner]), pa.array(number.astype(np.int32)), long_array(span_hashes(part, starts, ends)), long_array(span_hashes(part, starts, ends, _SECOND)),
                     null(keys[0], near), null(keys[1], near), null(keys[2], near & ~same), null(keys[3], near & ~same)],
                    names=["doc_id", "line", "h1", "h2", "p", "s", "p2", "s2"])

    return run


def _line_variants(text: str, prefix: bool, suffix: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes and the deleted place (-1: none) of a line and its variants. ``prefix``: the first half is shared, so the edit is in the last."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = len(codes)
    half = (n - 1) // 2
    at = np.arange(n)
    at = at[((at >= half) & prefix) | ((at < n - half) & suffix)]
    up, _ = powers(n + 1)
    out = []
    for salt in (_SALT[0], _SALT[3]):
        values = mix(codes * salt + np.uint64(1))
        before = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], out=before[1:])
        behind = np.zeros(n + 1, np.uint64)  # sums from the right as if moved one place to the left
        # Character j > i of a variant without i stands at place j - 1.
        behind[: n - 1] = np.cumsum((values[1:] * up[: n - 1])[::-1])[::-1]
        gone = before[at] + behind[at]
        out.append(np.concatenate([mix(before[n : n + 1] + np.uint64(n)), mix(gone + np.uint64(n - 1))]))
    return out[0], out[1], np.concatenate([[-1], at])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Variants of the lines (doc_id, line, prefix, suffix, text), given out whenever there are ``_MOST`` of them."""
    for batch in batches:
        parts, n = [], 0
        rows = zip(*(batch.column(i) for i in range(5)))
        for i, (doc, number, prefix, suffix, text) in enumerate(rows):
            k, c, at = _line_variants(text.as_py(), prefix.as_py(), suffix.as_py())
            parts.append((k, c, at, np.full(len(k), doc.as_py()), np.full(len(k), number.as_py())))
            n += len(k)
            if n >= _MOST or i == batch.num_rows - 1:
                columns = [np.concatenate(x) for x in zip(*parts)]
                yield pa.RecordBatch.from_arrays(
                    [long_array(columns[0]), long_array(columns[1]), pa.array(columns[2].astype(np.int32)), pa.array(columns[3].astype(np.int64)), pa.array(columns[4].astype(np.int32))],
                    names=["key", "check", "place", "doc_id", "line"])
                parts, n = [], 0


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads variants in the order (key, check, place, doc_id, line) and gives each line that meets an earlier one, with that one."""
    group = whole = first = None  # the variant, the whole line equal to it, and the first line with the present deleted place
    for batch in batches:
        out = []
        rows = zip(*(batch.column(i).to_pylist() for i in range(5)))
        for key, check, place, doc, line in rows:
            me = (doc, line)
            if (key, check) != group:
                group, whole, first = (key, check), None, None
            if place == -1:
                whole = me if whole is None else whole
                continue
            if first is None or first[0] != place:
                first = (place, me)
            elif first[1] < me:
                out.append((*me, *first[1]))
            if whole is not None and whole < me:
                out.append((*me, *whole))
            elif whole is not None and me < whole:
                out.append((*whole, *me))
        columns = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int32()))], names=["doc_id", "line", "by_doc", "by_line"])


def within_one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced character at most makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _line_texts(docs: DataFrame, wanted: DataFrame, min_chars: int) -> DataFrame:
    """``wanted`` with the text of the lines that (doc_id, line) name. Texts are cut into lines before the join, so no row is longer than a line."""
    cut = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line", "text")).where(F.length("text") >= min_chars)
    return cut.join(small_side(wanted, 64), ["doc_id", "line"]).select(*wanted.columns, "text")


def _pair_texts(met: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``met`` with the texts of both lines: own and other. An earlier line that many meet is there once, whatever its length."""
    by = ["by_doc", "by_line"]
    text = texts.select(F.col("doc_id").alias("by_doc"), F.col("line").alias("by_line"), F.col("text").alias("other"))
    others = stored(met.sparkSession, text.join(small_side(stored(met.sparkSession, met.select(*by).distinct(), "earlier"), 64), by).distinct(), "earlier-texts")
    own = texts.select("doc_id", "line", F.col("text").alias("own")).join(small_side(met, 72), ["doc_id", "line"]).distinct()
    return own.join(small_side(others, 64, F.octet_length("other")), by)


def first_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Rows (doc_id, line) of the lines that stay, blank lines left out."""
    spark, usable = docs.sparkSession, docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    rows = usable.select("doc_id", "text").mapInArrow(_line_rows(min_chars), "doc_id long, line int, h1 long, h2 long, p long, s long, p2 long, s2 long")
    firsts = rows.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "line")).alias("at"), *[F.first(c).alias(c) for c in ("p", "s", "p2", "s2")])
    firsts = stored(spark, firsts.select("at.*", "h1", "p", "s", "p2", "s2"), "lines")

    halves = firsts.select("doc_id", "line", "h1", F.explode(F.array(
        *[F.struct(F.col(c).alias("key"), F.lit(c.startswith("p")).alias("prefix")) for c in ("p", "s", "p2", "s2")])).alias("half")).where("half.key IS NOT NULL")
    beside = Window.partitionBy("half.key").orderBy("h1")
    halves = halves.withColumn("shared", F.lag("h1").over(beside).isNotNull() | F.lead("h1").over(beside).isNotNull()).where("shared")
    near = halves.groupBy("doc_id", "line").agg(F.max("half.prefix").alias("prefix"), F.max(~F.col("half.prefix")).alias("suffix"))
    texts = stored(spark, _line_texts(usable, stored(spark, near, "wanted"), min_chars), "line-texts")
    variants = texts.mapInArrow(_variants, "key long, check long, place int, doc_id long, line int")
    met = variants.repartition("key").sortWithinPartitions("key", "check", "place", "doc_id", "line").mapInArrow(_meet, "doc_id long, line int, by_doc long, by_line int")
    met = stored(spark, met.distinct(), "met")
    both = _pair_texts(met, texts)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = batch.column("own").to_pylist(), batch.column("other").to_pylist()
            right = [x is not None and y is not None and min(len(x), len(y)) >= min_chars and within_one_edit(x, y) for x, y in zip(own, other)]
            yield batch.select(["doc_id", "line"]).filter(pa.array(right, pa.bool_()))

    gone = both.mapInArrow(verify, "doc_id long, line int").distinct()
    return firsts.select("doc_id", "line").join(gone, ["doc_id", "line"], "left_anti")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """All columns of ``docs`` with repeated lines cut out of ``text``, then ``_n_lines`` and ``_n_removed`` (lengthened by ``_`` if taken)."""
    at, columns = docs.columns.index("text"), docs.columns
    id_name, kept_name, total, removed = (free_name(columns, name) for name in ("_id", "_kept", "_n_lines", "_n_removed"))
    kept = first_lines(docs, min_chars).groupBy(F.col("doc_id").alias(id_name)).agg(F.collect_list("line").alias(kept_name))

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_removed = [], [], []
            known = batch.column(len(columns)).is_valid()
            for text, kept, ok in zip(batch.column(at), batch.column(len(columns) + 1), known):
                text, stays = text.as_py(), set(kept.as_py() or ())
                split = text.split("\n") if text is not None else []
                left = [x for i, x in enumerate(split) if not ok.as_py() or i in stays or not x.strip("\t\x0b\x0c\r ")]
                texts.append("\n".join(left) if text is not None else None)
                n_lines.append(len(split))
                n_removed.append(len(split) - len(left))
            arrays = [pa.array(texts, batch.column(at).type) if i == at else batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())], names=[*columns, total, removed])

    joined = docs.join(kept, docs["doc_id"] == kept[id_name], "left").select(*[F.col(f"`{c}`") for c in columns], F.col("doc_id").alias(id_name), kept_name)
    schema = StructType([*docs.schema.fields, StructField(total, LongType()), StructField(removed, LongType())])
    return joined.toDF(*[f"c{i}" for i in range(len(columns) + 2)]).mapInArrow(rebuild, schema)  # names with dots are back in the result
