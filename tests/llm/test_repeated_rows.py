"""Repeated rows, shared and NULL ids, clashing names and very long values: a defined result, no crash and no lost row."""

import base64
import hashlib

import pytest

from tabwork.llm import decontam, lines, suffix, warc


def _bare(payload):
    return base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()


def test_equal_rows_of_two_partitions_are_records_of_their_own(spark, tmp_path):
    html = "<p>é" * 50_000
    pages = spark.createDataFrame([(1, "u", html), (1, "u", html), (2, "v", "x"), (None, "u", html)], "page_id long, url string, html string").repartition(4)
    warc.write_archives(pages, f"{tmp_path}/a")
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_digest"]) for r in warc.read_archives(spark, f"{tmp_path}/a").collect())
    assert got == [(0, "revisit", 1, _bare(html)), (1, "response", None, _bare(html)), (1, "response", None, _bare(html)), (2, "response", None, _bare("x"))]


def test_a_payload_of_fifty_megabytes(spark, tmp_path):
    pages = spark.range(1).selectExpr("id AS page_id", "'u' AS url", "repeat('0123456789abcde\\n', 3276800) AS html", "1 AS record", "2 AS data")
    warc.write_archives(pages, f"{tmp_path}/a", chunk_bytes=1 << 20)
    row = warc.read_archives(spark, f"{tmp_path}/a").first()
    assert (row["payload_bytes"], row["n_chunks"], row["payload_digest"]) == (16 * 3276800, 50, _bare("0123456789abcde\n" * 3276800))


@pytest.mark.parametrize("chunk", [1, 3, 16])
def test_record_table_holds_every_byte_once(spark, chunk):
    texts = ["", None, "a\r\n\r\nWARC/1.1\r\nb", "\r\n" * 20, "é" * 9]
    table = warc.record_table(spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").selectExpr("*", "'u' AS url"), chunk)
    parts = {}
    for r in table.orderBy("record", "chunk").collect():
        parts.setdefault(r["page_id"], []).append(r)
    for i, text in enumerate(texts):
        assert b"".join(bytes(r["data"]) for r in parts[i]) == (text or "").encode() and [r["chunk"] for r in parts[i]] == list(range(1, len(parts[i]) + 1))
        assert [r["last"] for r in parts[i]] == [False] * (len(parts[i]) - 1) + [True] and all(len(r["data"]) <= chunk for r in parts[i])
        assert parts[i][-1]["sha1"] == hashlib.sha1((text or "").encode()).hexdigest()


def test_spans_of_texts_that_share_an_id(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(None, passage), (None, " ".join(f"s{i}" for i in range(30))), (1, "a b " + passage), (1, "c " + " ".join(f"q{i}" for i in range(70))), (1, passage + " d"), (2, None)]
    got = sorted((r["doc_id"] or 0, r["start_word"], r["end_word"]) for r in suffix.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 0, 60), (1, 0, 60), (1, 2, 62)]
    only = spark.createDataFrame([(None, passage), (None, passage + " e")], "doc_id long, text string")
    for held in (1, 32768):
        assert [(r["start_word"], r["end_word"]) for r in suffix.repeated_spans(only, held=held).collect()] == [(0, 60), (0, 60)]


def test_line_dedup_keeps_columns_with_its_own_names(spark):
    line = "the quick brown fox jumps"
    docs = spark.createDataFrame([(1, line, "a", 1, 2, "x"), (2, line + "!\nrest", "b", 3, 4, "y"), (2, line + "!\nrest", "b", 3, 4, "y"), (None, line, "c", 5, 6, "z")],
                                 "doc_id long, text string, _id string, _kept int, _n_lines long, `dot.ted` string")
    found = lines.dedup_lines(docs)
    assert found.columns == [*docs.columns, "_n_lines_", "_n_removed"]
    got = sorted((r["doc_id"] or 0, r["text"], r["_id"], r["_kept"], r["_n_lines"], r["dot.ted"], r["_n_lines_"], r["_n_removed"]) for r in found.collect())
    assert got == [(0, line, "c", 5, 6, "z", 1, 0), (1, line, "a", 1, 2, "x", 1, 0), (2, "rest", "b", 3, 4, "y", 2, 1), (2, "rest", "b", 3, 4, "y", 2, 1)]
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_a_benchmark_in_blocks_and_an_item_beyond_a_block(spark, monkeypatch):
    long = " ".join(f"L{i}" for i in range(3000))
    items = spark.createDataFrame([("a", long), ("b", "one two three"), ("c", "tiny"), ("d", None), ("e", long)], "item_id string, text string")
    texts = ["x " + " ".join(f"l{i}" for i in range(500, 560)) + " y", "ONE, two; three four", "tiny " * 3, long, None, "", "clean words only", "clean words only", long]
    docs = spark.createDataFrame([(i % 5, t, "keep") for i, t in enumerate(texts)], "doc_id long, text string, digest string")
    made, real = [], decontam.Windows.__init__
    monkeypatch.setattr(decontam.Windows, "__init__", lambda self, rows: made.append(len(rows)) or real(self, rows))
    show = lambda df: sorted(map(str, df.collect()))
    whole, blocks = decontam.contamination(docs, items), decontam.contamination(docs, items, max_chars=60_000)
    assert show(whole) == show(blocks) and len(made) > 5 and max(made[1:]) < made[0] / 3
    got = sorted((r["n_words"], r["n_hit"], tuple(r["items"])) for r in blocks.collect())
    assert got == [(0, 0, ()), (0, 0, ()), (3, 0, ()), (3, 0, ()), (3, 3, ("c",)), (4, 3, ("b",)), (62, 60, ("a", "e")), (3000, 3000, ("a", "e")), (3000, 3000, ("a", "e"))]
    assert decontam.decontaminate(docs, items, max_chars=60_000).columns == docs.columns and decontam.decontaminate(docs, items, max_chars=60_000).count() == 4
