"""Operators on corpora: SQL checks of the queries, and defined results on awkward rows."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tabwork.llm import chat, common, decontam, jaccard, langid, lines, pieces, quality, suffix, voronoi, warc
from tabwork.llm.queries import ORACLE, QUERIES
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, score string"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) is None


@pytest.fixture(scope="module")
def awkward(spark):
    """NULLs, empty and blank texts, repeated rows, a long text, and extra columns with clashing names."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
    rows = [(1, None, None, "s"), (2, "", "en", None), (3, " \n\t", "en", "s"), (4, "one two", "en", "s"), (4, "one two", "en", "s"),
            (5, "ONE two", None, "s"), (None, "one two", "en", "s"), (6, long, "en", "s"), (7, long + " end", "en", "s")]
    return spark.createDataFrame(rows, DOCS)


def test_sentencepiece_equals_the_library(spark, awkward):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(1)
    parts = [" ", "  ", "▁", "a", "the", "é", "\n", "日", "😀", "\x00", "<s>", "x", "ing", "\t"]
    more = spark.createDataFrame([(i, "".join(rng.choice(parts) for _ in range(rng.randrange(30))), None, None) for i in range(100)], DOCS)
    for df in (awkward, more, awkward.limit(0)):
        texts = sorted((r["text"] or "" for r in df.collect()))
        got = sorted((tuple(r["ids"]), r["ids_sha256"], r["decoded_sha256"]) for r in pieces.encode_decode(df, path).collect())
        want = []
        for text in texts:
            ids = [model.bos_id(), *model.encode(text), model.eos_id()]
            want.append((tuple(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()))
        assert got == sorted(want)


def test_contamination_of_awkward_rows(spark, awkward):
    items = spark.createDataFrame([(1, "two"), (2, None), (3, "One  two"), (None, "!!")], "item_id long, text string")
    rows = {(r["doc_id"], r["n_words"]): r for r in decontam.contamination(awkward, items).collect()}
    assert rows[(1, 0)]["contaminated"] is False and rows[(4, 2)]["n_hit"] == 2 and rows[(4, 2)]["items"] == ["1", "3"]
    blocks = decontam.contamination(awkward, items, max_chars=3)
    assert sorted(map(str, blocks.collect())) == sorted(map(str, decontam.contamination(awkward, items).collect()))
    assert decontam.decontaminate(awkward, items).columns == awkward.columns
    assert decontam.decontaminate(awkward, items.limit(0)).count() == awkward.count()
    cut = {r["doc_id"]: r["text"] for r in decontam.decontaminate(awkward, items, spans=True).collect()}
    assert cut[5] == "" and cut[1] is None


@pytest.mark.parametrize("chunk", [7, 1 << 16])
def test_warc_round_trip(spark, tmp_path, chunk):
    mark = "\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "u", "abc"), (2, "u", None), (3, None, ""), (4, "u", "abc"), (5, "u", mark * 5), (6, "x", "WARC/1.1\r\n" + mark + "é" * 50), (None, "q", "abc"), (7, "z", "\r\n" * 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/a", chunk_bytes=chunk)
    got = {r["page_id"]: r for r in warc.read_archives(spark, f"{tmp_path}/a").collect()}
    assert len(got) == len(rows)
    assert (got[1]["record_type"], got[1]["refers_to"], got[1]["payload_bytes"]) == ("revisit", 4, 3)
    assert got[2]["refers_to"] == 3 and got[None]["refers_to"] == 4 and got[5]["payload_bytes"] == len(mark) * 5
    assert got[5]["n_chunks"] > 1
    warc.write_archives(pages.limit(0), f"{tmp_path}/b")
    assert warc.read_archives(spark, f"{tmp_path}/b").count() == 0


def test_chat_windows_read_back(spark):
    rows = [(1, 0, "system", "be\\l <|end|>"), (1, 1, None, None), (1, 2, "assistant", "<|turn|>x" * 200), (1, 2, "assistant", "<|turn|>x" * 200), (1, 3, "user", "q" * 3000), (None, None, "user", "hi")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.chat_windows(turns, budget=700)
    got = {r["conv_id"]: r for r in chat.read_windows(windows).collect()}
    said = [((r or ""), (t or "")) for _, _, r, t in rows[:5]]
    assert got[1]["n_turns"] == 5 and got[1]["loss_chars"] == 3600
    assert got[1]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
    assert all(r["formatted"].startswith("<|turn|>system") for r in windows.where("conv_id = 1").collect()) and windows.where("conv_id = 1").count() > 1
    assert chat.read_windows(chat.chat_windows(turns.limit(0))).count() == 0


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_lines_against_brute_force(spark):
    rng, base = random.Random(4), ["the quick brown fox jumps é over", "a" * 25, "pack my box with five dozen jugs"]

    def edited(line):
        i = rng.randrange(len(line) + 1)
        return rng.choice([line, line[:i] + "z" + line[i:], line[:i] + line[i + 1 :], line[:i] + "y" + line[i + 1 :], "", "short"])

    texts = ["\n".join(edited(rng.choice(base)) for _ in range(6)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(90, None), (91, ""), (None, base[0])]
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    seen = []
    for i, text in enumerate(texts):
        left = []
        for line in text.split("\n"):
            if line and any(line == s or (min(len(line), len(s)) >= 20 and _edits(line, s) <= 1) for s in seen):
                seen.append(line)
                continue
            seen.append(line) if line else None
            left.append(line)
        assert got[i] == "\n".join(left)
    assert got[90] is None and got[91] == "" and got[None] == base[0]


def test_jaccard_against_brute_force(spark, awkward):
    rng = random.Random(7)
    vocabulary = [f"v{i}" for i in range(40)]
    texts = []
    for _ in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 14, 60, 200]))]
        texts += [" ".join(rng.choice(vocabulary) if rng.random() < 0.01 else w for w in words) for _ in range(8)]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for t in texts)]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in jaccard.groups(docs).collect()} == dict(enumerate(label))
    found = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard.groups(awkward).collect()}
    assert found[(4, 1)] == 4 and found[(5, 1)] == 4 and found[(1, 0)] == 1 and found[(None, 1)] is None
    assert jaccard.keep_first(awkward).columns == awkward.columns and jaccard.groups(awkward.limit(0)).count() == 0


def test_repeated_spans_within_frequent_seeds(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"a{i} " * 7 + passage + f" b{i}" * 5) for i in range(30)] + [(99, "c " + " ".join(f"q{i}" for i in range(80))), (98, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for held in (4, 32768):
        got = {r["doc_id"]: (r["start_word"], r["end_word"]) for r in suffix.repeated_spans(docs, held=held).collect()}
        assert got == {i: (7, 67) for i in range(30)}
    assert suffix.repeated_spans(docs.limit(0)).count() == 0


def test_top_k_of_awkward_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, None]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [-1.0]), (None, [1.0, 1.0])]
    vectors = voronoi.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = voronoi.top_k(vectors, F.col("id") == 0, k=5, block_rows=2).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(4, 65536), (5, 65536), (5, 65536), (6, -65536)]
    assert voronoi.top_k(vectors.limit(0), F.lit(True)).count() == 0


def test_quality_model_learns_and_keeps_all_columns(spark, awkward):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train_on_labels(docs, labels)
    rows = quality.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95 and np.mean([g >= 0.3 for g in good]) > 0.95
    scored = quality.score(awkward, model)
    assert scored.count() == awkward.count() and scored.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert quality.keep_good(awkward, model).columns == awkward.columns
    with pytest.raises(ValueError):
        quality.train_on_labels(docs, labels.limit(0))


def test_non_negative_risk_falls():
    rng = np.random.default_rng(0)
    positive, unlabelled = rng.normal(1, 1, (300, 3)).astype(np.float32), np.concatenate([rng.normal(1, 1, (200, 3)), rng.normal(-1, 1, (200, 3))]).astype(np.float32)
    _, _, risks = quality.minimise(positive, unlabelled, 0.5)
    assert min(risks) >= 0 and risks[-1] < risks[0]


def test_recurrent_gradients_and_reading():
    rng = np.random.default_rng(0)
    layer = langid.Direction(rng.normal(0, 0.3, (24, 257)), rng.normal(0, 0.3, (24, 8)))
    steps = rng.integers(0, 256, (12, 5))
    states, past = layer.run(steps)
    assert max(np.abs(a.T - b).max() for a, b in zip(states, layer.read(steps))) < 1e-5
    outer = [rng.normal(size=s.shape) for s in states]
    loss = lambda: sum((s * o).sum() for s, o in zip(layer.run(steps)[0], outer))
    d_table, d_recurrent = layer.back(past, outer)
    for weights, gradient, at in ((layer.recurrent, d_recurrent, (3, 2)), (layer.recurrent, d_recurrent, (20, 1)), (layer.table, d_table, (4, steps[3, 2]))):
        weights[at] += 1e-4
        up = loss()
        weights[at] -= 2e-4
        assert abs((up - loss()) / 2e-4 - gradient[at]) < 1e-3
        weights[at] += 1e-4


def test_language_held_out_accuracy(spark, awkward):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    rows = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    found = {r["doc_id"]: r["lang_pred"] for r in langid.predict(awkward, model).collect()}
    assert found[1] == found[2] == found[3] == "und" and found[4] in model.names


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_line_texts_are_joined_as_single_lines(spark):
    long = "x" * 30_000
    rows = [(0, long)] + [(i, long[:i] + "y" + long[i + 1 :]) for i in range(1, 40)]
    docs = spark.createDataFrame([*rows, (50, "z" * 30), (50, "w" * 30), (51, "w" * 29 + "v"), (52, "z" * 29)], "doc_id long, text string")
    met = spark.createDataFrame([(i, 0, 0, 0) for i in range(1, 40)], "doc_id long, line int, by_doc long, by_line int")
    wanted = spark.createDataFrame([(i, 0) for i in range(40)], "doc_id long, line int")
    both = lines._pair_texts(met, lines._line_texts(docs, wanted, 20))
    assert "collect_list" not in _plan(both) and both.count() == 39
    kept = {r["doc_id"] for r in lines.dedup_lines(docs).where("text <> ''").collect()}
    assert kept == {0, 50}


def test_broadcast_counts_the_bytes_of_texts_and_arrays(spark):
    few = spark.createDataFrame([(1, "x" * 5000, [1] * 5000)], "doc_id long, text string, places array<int>")
    marked = lambda df: "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert marked(common.small_side(few, 8, F.octet_length("text"), limit=6000)) and not marked(common.small_side(few, 8, F.octet_length("text"), limit=4000))
    assert not marked(common.small_side(few, 8, 5 * F.size("places"), limit=20_000))


def test_forms_with_own_words_are_not_compared_in_all_pairs(spark, monkeypatch):
    form = " ".join(f"c{i}" for i in range(89))
    texts = [form + "".join(f" o{i}x{j}" for j in range(15)) for i in range(60)]
    pairs, verify = [], jaccard._verify
    monkeypatch.setattr(jaccard, "_verify", lambda docs, known, found, bits: pairs.append(found.count()) or verify(docs, known, found, bits))
    got = {r["doc_id"]: r["component_id"] for r in jaccard.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: i for i in range(60)} and pairs[1] == 0
