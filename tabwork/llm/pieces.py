"""SentencePiece encoding and decoding by a table of distinct chunks.

A chunk is a run of whitespace markers with the marker-free characters behind it. Where no
piece of the vocabulary has a marker behind another character, no piece crosses the start of
a chunk, so a text's ids are the ids of its chunks one after the other. Each task keeps a
table of the distinct chunks it meets, segments each once by the library, and joins the ids
back by position with array lookups. The table is emptied when it reaches ``table_chunks``.
A global table by shuffle would move every word of the corpus to save segmenting, per task,
words that are met again anyway; so the table is per task.

Defined results: NULL text counts as empty; an empty text has the begin and end ids alone
and decodes to an empty text; repeated rows give repeated results; NULL ids of documents are
kept. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

MARK = "▁"
CHUNK = re.compile(f"[ {MARK}]*[^ {MARK}]+|[ {MARK}]+")
SCHEMA = "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"


def chunkable(model: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether no piece holds a whitespace marker behind another character, and a text only gets one marker in front."""
    crossing = re.compile(f"[^{MARK}]{MARK}")
    plain = all(not crossing.search(model.id_to_piece(i)) for i in range(len(model)))
    return plain and model.encode("a  b", out_type=str)[0].startswith(MARK) and model.decode(model.encode("  a  b ")) == "  a  b "


class ChunkTable:
    """Ids of distinct chunks. A chunk is keyed by its text without its first marker, which the library adds itself."""

    def __init__(self, model: sentencepiece.SentencePieceProcessor, limit: int):
        self.model, self.limit = model, limit
        self.index: dict[str, int] = {}
        self.ids, self.starts = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _extend(self, texts: list[str]) -> None:
        # A chunk of one marker alone would be the empty text to the library.
        alone = [self.model.piece_to_id(MARK)]
        found = [ids if text else alone for text, ids in zip(texts, self.model.encode(texts, num_threads=1))]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.ids = np.concatenate([self.ids, np.fromiter((i for ids in found for i in ids), np.int32, int(lengths.sum()))])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text starts."""
        if len(self.index) > self.limit:
            self.__init__(self.model, self.limit)
        index, fresh, where, ends = self.index, [], [], []
        for text in texts:
            # The library puts one marker in front of a text, so the first chunk lacks it and the others carry it.
            for chunk in CHUNK.findall(" " + text) if text else ():
                key = chunk[1:]
                at = index.get(key)
                if at is None:
                    at = index[key] = len(index)
                    fresh.append(key)
                where.append(at)
            ends.append(len(where))
        if fresh:
            self._extend(fresh)
        at = np.array(where, np.int64)
        lengths = self.starts[at + 1] - self.starts[at]
        stops = np.cumsum(lengths)
        flat = np.arange(int(stops[-1]) if len(stops) else 0) + np.repeat(self.starts[at] - (stops - lengths), lengths)
        cuts = np.concatenate([[0], stops])[np.concatenate([[0], ends]).astype(np.int64)]
        return self.ids[flat], cuts


def encode_decode(docs: DataFrame, model_path: str, keep_ids: bool = True, table_chunks: int = 400_000) -> DataFrame:
    """Token ids of every text with begin and end ids, and digests of the ids and of the text decoded from them.

    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit integers. The model file is
    read on the driver and travels with the tasks.
    """
    with open(model_path, "rb") as file:
        proto = file.read()
    schema = SCHEMA if keep_ids else SCHEMA.replace("ids array<int>, ", "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        table = ChunkTable(model, table_chunks) if chunkable(model) else None
        begin, end = model.bos_id(), model.eos_id()
        for batch in batches:
            doc_ids, column, lo, step = batch.column(0), batch.column(1), 0, 256
            while lo < len(column):
                texts = [t or "" for t in column.slice(lo, step).to_pylist()]
                if table:
                    flat, cuts = table.encode(texts)
                else:
                    found = model.encode(texts, num_threads=1)
                    cuts = np.concatenate([[0], np.cumsum([len(f) for f in found])])
                    flat = np.array([i for f in found for i in f], np.int32)
                ids = [np.concatenate([[begin], flat[a:b], [end]]).astype("<u4") for a, b in zip(cuts[:-1], cuts[1:])]
                lists = [x.tolist() for x in ids]
                decoded = model.decode(lists, num_threads=1)
                columns = {
                    "doc_id": doc_ids.slice(lo, step).cast(pa.int64()),
                    "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                    "ids": pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())) if keep_ids else None,
                    "ids_sha256": pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string()),
                }
                yield pa.RecordBatch.from_pydict({k: v for k, v in columns.items() if v is not None})
                lo += step

    return docs.select("doc_id", "text").mapInArrow(run, schema)
