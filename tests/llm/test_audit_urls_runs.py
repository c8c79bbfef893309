"""Filter audit, URL rules with aliases, and periodic runs, against brute force and on awkward rows."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tabwork.llm import filters, runs, urls

WORDS = "[\x20\x09-\x0D]+"


def _split(text):
    return [x for x in re.split(WORDS, text or "") if x]


def _audit_by_hand(docs, labels):
    least, rows = {}, []
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for row in docs:
        i, text, source = row
        t, w = text or "", _split(text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
                 "D": bool(set(t) & set("#$%&*|")), "E": i is not None and least[t] < i}
        rows.append((source or "", {k for k, v in fails.items() if v}, any(j == i and q == 1 for j, q, _ in labels if j is not None), any(j == i and x == 1 for j, _, x in labels if j is not None)))
    found = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                out = [r for r in left if f in r[1]]
                gone = sum(f in r[1] for r in own) - len(out)
                left = [r for r in left if f not in r[1]]
                removed_by[f] += len(out)
                found[part, order, step] = [len(left), len(out), gone, sum(r[1] == {f} for r in own), sum(r[2] for r in out), sum(r[3] for r in out)]
        for (p, order, step), row in found.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return {k: tuple(v) for k, v in found.items()}


def test_audit_against_every_order(spark):
    rng = random.Random(2)
    texts = [None, "", "a", "A B", "#", " ".join(f"w{i}" for i in range(200)), " ".join(f"w{i % 9}" for i in range(250)), "W " * 220, " ".join(f"W{i}|" for i in range(300))]
    docs = [(i, rng.choice(texts), rng.choice(["s", "t", "", None])) for i in range(60)] + [(3, "twice", "s"), (3, "twice", "t"), (None, "twice", "s"), (2, "twice", "u"), (None, None, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 60, 2)] + [(4, 1, 0), (4, 0, 1), (999, 1, 1), (None, 1, 1)]
    # Extra columns with the names that the operator uses itself.
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({c: F.lit(7) for c in ("part", "mask", "digest", "n", "good", "first")}).repartition(3)
    named = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit(1))
    got = {(r[0], r[1], r[2]): tuple(r)[3:] for r in filters.audit(filters.mask_counts(df, named)).collect()}
    assert got == _audit_by_hand(docs, labels)
    assert filters.audit(filters.mask_counts(df.limit(0), named)).count() == 0
    unlabelled = filters.audit(filters.mask_counts(df, named.limit(0))).agg(F.sum("good_lost"), F.count("*")).first()
    assert tuple(unlabelled) == (0, 120 * 5 * 4)  # the parts are s, t, u and the empty one


def test_intervals_cover_each_order_once():
    rows = filters.rank_intervals("ABCDE")
    for mask in range(1, 32):
        at = sorted((low, high) for m, _, _, low, high in rows if m == mask)
        assert at[0][0] == 0 and at[-1][1] == 120 and all(a[1] == b[0] for a, b in zip(at, at[1:]))
    with pytest.raises(ValueError):
        filters.audit(None, "ABA")


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("x.org", "/", "block"), ("y.org", "", "block"), ("y.org", "/ok", "allow")]


def test_rules_and_aliases(spark):
    pages = [
        (1, "http://a.net/x"), (2, "HTTP://A.NET"), (3, "http://w.example.net/en/1?q#f"), (4, "http://w.example.net/fr/"), (5, "https://Example.COM/de/1"), (6, "https://notexample.com/de/1"),
        (7, "http://o.org/fr/x"), (8, "http://x.org/fr/x"), (9, None), (10, "no scheme"), (11, ""), (12, "http://y.org"), (13, "http://y.org/ok/1"), (1, "http://a.net/x"), (None, "http://q.io/"),
        # a chain of aliases to a blocked page, one explicitly allowed member, and a class that holds a cycle
        (20, "http://c.io/1"), (21, "http://c.io/2#top"), (22, "http://c.io/3"), (23, "http://d.io/1"), (24, "http://d.io/2"), (25, "http://e.io/1"), (26, "http://e.io/2"), (27, "http://f.io"),
    ]
    links = [("http://c.io/1", "http://c.io/2"), ("http://c.io/2", "http://c.io/3#x"), ("http://c.io/3", "http://unseen.net/"),
             ("http://d.io/1", "http://d.io/2"), ("http://d.io/2", "http://a.net/x"), ("http://d.io/2", "http://o.org/fr/x"),
             ("http://e.io/1", "http://e.io/2"), ("http://e.io/2", "http://e.io/1"), ("http://F.io/", "http://e.io/1"), (None, "http://a.net/x"), ("http://e.io/1", None), ("no scheme", "http://a.net/x")]
    frame = spark.createDataFrame(pages, "page_id long, url string").withColumns({c: F.lit("c") for c in ("rule", "host", "path", "node", "component", "said")})
    rules, joined = spark.createDataFrame(RULES, urls.RULES), spark.createDataFrame(links, "source string, target string")
    rows = urls.verdicts(frame, rules, joined).collect()
    assert len(rows) == len(pages)
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in rows}
    assert got == {
        1: ("net/", "block"), 2: (None, "allow"), 3: ("example.net/en/", "allow"), 4: ("net/", "block"), 5: ("example.com/de/", "block"), 6: (None, "allow"), 7: ("org/fr/", "allow"),
        8: ("org/fr/", "allow"), 9: (None, "allow"), 10: (None, "allow"), 11: (None, "allow"), 12: ("y.org", "block"), 13: ("y.org/ok", "allow"), None: (None, "allow"),
        20: (None, "block"), 21: (None, "block"), 22: (None, "block"), 23: (None, "allow"), 24: (None, "allow"), 25: (None, "allow"), 26: (None, "allow"), 27: (None, "allow")}
    parts = {r["page_id"]: (r["host"], r["path"]) for r in rows}
    assert parts[2] == ("a.net", "") and parts[3] == ("w.example.net", "/en/1") and parts[9] == parts[10] == ("", "")
    assert urls.verdicts(frame.limit(0), rules, joined).count() == 0
    assert {r["verdict"] for r in urls.verdicts(frame, rules.limit(0), joined.limit(0)).collect()} == {"allow"}


def test_many_aliases_of_one_page(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.io/"), F.col("id")).alias("url"))
    star = pages.where("page_id > 0").select(F.col("url").alias("source"), F.lit("http://h.io/0").alias("target"))
    bad = spark.createDataFrame([("h.io", "/0", "block")], urls.RULES)
    assert urls.verdicts(pages, bad, star).where("verdict = 'block'").count() == 3000
    assert urls.verdicts(pages, bad, star.limit(0)).where("verdict = 'block'").count() == 1


def test_links_in_html(spark):
    base = "http://h.io/a/b.html?x=1#f"
    html = {
        '<LINK href="/c" REL=\'Canonical\'>': "http://h.io/c", "<link rel=canonical href=c?y=2>": "http://h.io/a/c?y=2", '<link rel="alternate canonical" href="//o.io/p&amp;q">': "http://o.io/p&q",
        '<meta http-equiv=refresh content="0; url=../up">': "http://h.io/up", "<meta http-equiv='Refresh' content=\"5;URL='https://z.io/'\">": "https://z.io/", '<link rel="canonical" href="./">': "http://h.io/a/",
        '<link rel=canonical href="?z">': "http://h.io/a/b.html?z", '<link rel=canonical href="../../../t/./u">': "http://h.io/t/u",
        '<!-- <link rel=canonical href="/no"> --><script>"<link rel=canonical href=/no>"</script>': None, "<link rel=stylesheet href=/canonical>": None, '<link rel=canonical href="mailto:a@b">': None,
        "<meta name=refresh content='0;url=/no'>": None, "<link rel=canonical>": None, "plain canonical text": None, "": None, "<p>" + "<link rel=x>" * 5000: None,
    }
    rows = [(i, base, h) for i, h in enumerate(html)] + [(90, None, "<link rel=canonical href=/c>"), (91, base, None), (92, "x", "<link rel=canonical href=/c>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [r["target"] for i in range(len(html)) for r in urls.html_links(pages.where(F.col("page_id") == i)).collect() or [{"target": None}]]
    assert got == list(html.values())
    assert urls.html_links(pages.where("page_id >= 90")).count() == 0


def _runs_by_hand(w, min_length, exponent):
    found = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(min_length, exponent * q) and not any(all(w[x] == w[x + p] for x in range(i, i + n - p)) for p in range(1, q)):
                found.append((i, n, q))
            i = j + 1
    return sorted(found)


def _periodic(rng, letters, size):
    w = ([rng.choice(letters) for _ in range(rng.randrange(1, 7))] * 40)[: rng.randrange(size)]
    for _ in range(rng.randrange(3)):
        if w:
            w[rng.randrange(len(w))] = rng.choice(letters)
    return w


@pytest.mark.parametrize("packed", [False, True])
def test_runs_of_one_stretch(monkeypatch, packed):
    monkeypatch.setattr(runs, "PACKED", 0 if packed else 10**9)
    rng = random.Random(3)
    for _ in range(400):
        w = _periodic(rng, range(rng.choice([1, 2, 3])), 50) + [rng.randrange(2) for _ in range(rng.randrange(20))]
        for least, exponent in ((6, 4), (3, 2), (5, 3)):
            assert runs.stretch_runs(w, least, exponent) == _runs_by_hand(w, least, exponent)


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (3, 2), (8, 7)])
def test_runs_of_documents(spark, least, exponent):
    rng = random.Random(least)
    words = ["a", "A", "bé", "日", "x-y"]
    rows = [(1, None), (2, ""), (3, " \n "), (None, "a " * 7), (4, "a " * 9), (4, "a " * 9), (None, "b")]
    for i in range(10, 150):
        w = _periodic(rng, words, 70)
        rows.append((i, rng.choice(["", " ", "\n"]) + "".join(x + rng.choice([" ", "  ", "\t", "\n\r "]) for x in w) + rng.choice(["", "end"])))
    rows.append((900, " ".join(f"w{i % 5000}" for i in range(22_000)) + " tail"))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"runs": F.lit(1), "n_words": F.lit("n")}).repartition(3)
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.periodic_runs(df, least, exponent).collect()), key=repr)
    want = []
    for i, text in rows:
        w = _split(text)
        found = ([(0, 22_000, 5000)] if exponent <= 4 else []) if i == 900 else _runs_by_hand(w, least, exponent)
        cut = {k for s, n, d in found for k in range(s + d, s + n)}
        want.append((i, len(w), found, " ".join(x for k, x in enumerate(w) if k not in cut)))
    assert got == sorted(want, key=repr)
    assert runs.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(df, 6, 1)


def test_highest_run_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(1, [(0, 8, 2), (3, 16, 4), (20, 9, 2), (40, 9, 2)]), (2, [(5, 8, 2), (5, 16, 4)]), (3, [])], "k int, runs array<struct<start: long, length: long, period: long>>")
    rows = {r["k"]: r["best"] for r in df.withColumn("best", runs.highest_run("runs")).collect()}
    assert tuple(rows[1]) == (20, 9, 2) and tuple(rows[2]) == (5, 8, 2) and rows[3] is None
