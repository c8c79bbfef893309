"""Large groups of near copies, and large groups of forms that are not: the number of compared pairs stays near the number of texts."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tabwork.llm import common, graph, jaccard


@pytest.fixture
def compared(monkeypatch):
    found, verify = [], jaccard._verify

    def counting(docs, known, pairs, bits):
        found.append(pairs.count())
        return verify(docs, known, pairs, bits)

    monkeypatch.setattr(jaccard, "_verify", counting)
    return found


@pytest.fixture(params=["lists", "parts"])
def long_lists(request, monkeypatch):
    """Long lists as they are, or listed anew by parts."""
    if request.param == "parts":
        monkeypatch.setattr(jaccard, "LONG", jaccard.LIGHT)


def test_a_group_of_two_thousand_near_copies(spark, compared, long_lists):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(2000):
        words = list(base)
        for _ in range(3):
            words[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    rows = jaccard.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)).collect()
    assert {r["component_id"] for r in rows} == {0}
    assert sum(compared) <= 5 * 2000


def test_two_thousand_forms_that_share_most_but_do_not_link(spark, compared, long_lists):
    common = [f"c{i}" for i in range(88)]
    texts = [" ".join([*common, *(f"o{i}x{j}" for j in range(25))]) for i in range(2000)]
    rows = jaccard.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)).collect()
    assert all(r["component_id"] == r["doc_id"] for r in rows)
    assert sum(compared) <= 5 * 2000


def test_large_sets_meet_by_wide_bitmaps(spark, compared, long_lists):
    """Texts of 6,000 words of which a third is common to all: too many shingles for the short bitmap to tell apart."""
    common = [f"c{i}" for i in range(2000)]
    texts = [" ".join([*common, *(f"o{i}x{j}" for j in range(4000 + i))]) for i in range(40)]
    texts += [f"{t} tail{i}" for i, t in enumerate(texts[:5])] + [texts[7], texts[7].rsplit(" ", 1000)[0]]
    rows = jaccard.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: i for i in range(40)} | {40 + i: i for i in range(5)} | {45: 7, 46: 7}


def test_texts_that_share_an_id(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    docs = spark.createDataFrame([(1, one, "p"), (1, two, "q"), (2, two + " end", "r"), (1, one, "p"), (None, two, "s"), (3, None, "t")], "doc_id long, text string, kept_id string")
    kept = sorted((r["doc_id"], r["kept_id"]) for r in jaccard.keep_first(docs).where("doc_id is not null").collect())
    assert kept == [(1, "p"), (1, "q"), (3, "t")] and jaccard.keep_first(docs).where("doc_id is null").count() == 1


def test_small_tables_are_kept_in_few_files(spark, monkeypatch):
    """Every table of the join once had as many tasks and files as a shuffle has partitions, however small."""
    written, stored = {}, graph.stored

    def counting(spark, df, name):
        made = stored(spark, df, name)
        written[name] = max(written.get(name, 0), len(made.inputFiles()))
        return made

    monkeypatch.setattr(jaccard, "stored", counting)
    monkeypatch.setattr(graph, "stored", counting)
    settings = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        texts = [" ".join(f"t{i // 2}w{j}" for j in range(40 + i % 2)) for i in range(600)]
        rows = jaccard.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert all(r["component_id"] == r["doc_id"] // 2 * 2 for r in rows)
    cores = spark.sparkContext.defaultParallelism
    assert all(written[name] <= 2 * cores for name in ("pairs", "places", "to", "alike", "ids", "verified", "links", "labels", "several")), written


def test_entries_that_cannot_link_are_not_kept(spark, monkeypatch):
    """Texts that share rare phrases, but of very different sizes or at places where no link can follow, once stayed in all lists."""
    kept, stored = {}, jaccard.stored

    def counting(spark, df, name):
        made = stored(spark, df, name)
        kept.setdefault(name, []).append(made.count())
        return made

    monkeypatch.setattr(jaccard, "stored", counting)
    texts = [" ".join([*(f"p{i}w{j}" for j in range(60)), *(f"q{i}s{size}w{j}" for j in range(size - 60))]) for i in range(40) for size in (120, 400)]
    texts += [f"{texts[2 * i]} end" for i in range(5)]
    rows = jaccard.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: i for i in range(80)} | {80 + i: 2 * i for i in range(5)}
    assert kept["lists"][0] <= 5 * 2 * 26  # first shingles of five pairs only


def test_lists_are_dealt_by_key_once_whatever_their_number(spark, monkeypatch):
    """Statistics of the lists once came by a shuffle of their own as soon as they were too many to be broadcast."""
    plans, stored = [], jaccard.stored

    def reading(spark, df, name):
        if name == "several":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(spark, df, name)

    monkeypatch.setattr(jaccard, "stored", reading)
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join([*base[:95], *(f"t{i}x{j}" for j in range(10))]) for i in range(8)] + [" ".join([*base, "a", "b"])]
    rows = jaccard.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
    assert len(rows) == 9 and plans
    assert all(plan.count("Exchange hashpartitioning(key") == 1 for plan in plans), plans


@pytest.mark.parametrize("size", [1, 3, 50, 1000])
def test_lists_cut_into_batches_keep_the_same_entries(size):
    """Lists of up to LIGHT entries lose those that fit with none; longer ones stay whole, wherever batches end."""
    rng = np.random.default_rng(7)
    rows = []
    for key, length in enumerate([2, 3, 40, 2, jaccard.LIGHT, jaccard.LIGHT + 1, 5, 90, 2, 2, 7]):
        for node in range(length):
            rows.append((key, 1000 * key + node, int(rng.integers(20, 60)), int(rng.integers(0, 8))))
    rows = np.array(rows)
    batches = [pa.RecordBatch.from_arrays([pa.array(c[i : i + size].astype(t)) for c, t in zip(rows.T, ("i8", "i8", "i4", "i4"))], names=["key", "node", "n", "pos"]) for i in range(0, len(rows), size)]
    got = [tuple(r.values()) for b in jaccard._fitting(False)(jaccard._scan(iter(batches))) for r in b.to_pylist()]
    want = []
    for key in np.unique(rows[:, 0]):
        own = [tuple(int(x) for x in r) for r in rows[rows[:, 0] == key]]
        left = own if len(own) > jaccard.LIGHT else [a for a in own if any(a != b and jaccard._possible(a[2], a[3], b[2], b[3]) for b in own)]
        want += [(*a, *left[0][1:]) for a in left]
    assert got == want
