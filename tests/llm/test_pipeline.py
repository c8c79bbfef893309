"""Stages of the corpus pipeline against the operators' own verdicts and brute force."""

import hashlib

import public_tokenizers
import sentencepiece

import corpus_pipeline
from tabwork.llm import common, decontam
from tabwork.plans.base import table

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = common.stored(spark, stage(spark, docs, SF), "stage")
        rows = docs.select("doc_id", "text").collect()
        assert docs.columns == columns and {r["doc_id"] for r in rows} <= before
        left[name] = {r["doc_id"]: r["text"] for r in rows}
    found = {r["doc_id"] for r in decontam.contamination(docs, table(spark, SF, "benchmark")).where("contaminated").collect()}
    assert not found and left["benchmark decontamination"]
    sets = {}
    for i, text in left["n-gram Jaccard join"].items():
        words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    for i, x in sets.items():
        for j, y in sets.items():
            assert i >= j or 100 * len(x & y) < 80 * len(x | y) or not x or not y
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    tokens = {r["doc_id"]: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    assert set(tokens) == set(left["benchmark decontamination"])
    for i, text in left["benchmark decontamination"].items():
        ids = [model.bos_id(), *model.encode(text or ""), model.eos_id()]
        assert list(tokens[i]["ids"]) == ids and tokens[i]["decoded_sha256"] == hashlib.sha256(model.decode(ids).encode()).hexdigest()
