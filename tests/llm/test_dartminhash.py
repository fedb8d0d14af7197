"""Signatures against weighted Jaccard similarities, classes against brute force."""

import random
from collections import Counter

import numpy as np

from metassoc.llm import dartminhash as dm

SCHEMA = "doc_id long, text string, class_id string"


def multiset(text):
    w = dm.words_of((text or "").lower())
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def similarity(a, b):
    low = sum((a & b).values())
    high = sum((a | b).values())
    return low / high if high else 0.0


def classes(rows):
    """{id: smallest id of the class} by comparing all pairs."""
    sets = [multiset(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] and (rows[i][1] == rows[j][1] or similarity(sets[i], sets[j]) >= 0.8):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(doc, least.get(root(i), doc))
    return {doc: least[root(i)] for i, (doc, _) in enumerate(rows)}


def run(spark, rows):
    out = dm.near_duplicates(spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)).collect()
    assert len(out) == len(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in out if r.doc_id is not None)
    return {r.doc_id: r.class_id for r in out}


def test_signature_agreement_is_the_weighted_similarity():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    docs = []
    for n in (5, 30, 300):
        base = [rng.choice(words[:6]) for _ in range(n)]
        docs += [base, base + [rng.choice(words) for _ in range(max(1, n // 10))], base[: n // 2 + 3]]
    doc, key = dm.strips(*dm.shingles(docs))
    k = 4000
    sig = dm.signatures(len(docs), doc, key, k)
    sets = [multiset(" ".join(d)) for d in docs]
    for i in range(len(docs)):
        for j in range(i):
            assert abs((sig[i] == sig[j]).mean() - similarity(sets[i], sets[j])) < 0.04


def test_fractional_weights():
    n, k = 40, 6000
    rng = np.random.default_rng(2)
    key = rng.integers(0, 2**63, n).astype(np.uint64)
    a, b = rng.random(n), rng.random(n)
    sig = dm.signatures(2, np.repeat([0, 1], n), np.concatenate((key, key)), k, np.concatenate((a, b)))
    assert abs((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_driver_table_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert run(spark, rows) == classes(rows)


def test_hot_group_shared_passage_and_chains(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(200)]
    rows = []
    for i in range(150):                      # near copies of one text, one word changed
        t = list(base)
        t[rng.randrange(200)] = word()
        rows.append((1000 + i, " ".join(t)))
    passage = [word() for _ in range(60)]
    rows += [(2000 + i, " ".join(passage + [word() for _ in range(60)])) for i in range(100)]
    chain = [word() for _ in range(150)]
    for i in range(12):                       # each text is similar to the next one only
        rows.append((3000 + i, " ".join(chain)))
        chain = chain[8:] + [word() for _ in range(8)]
    rng.shuffle(rows)
    assert run(spark, rows) == classes(rows)


def test_mixed_buckets_are_compared_again(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    shared = [word() for _ in range(300)]
    rows = []
    for i in range(60):                       # pairs of copies that all share three quarters of their text
        own = [word() for _ in range(100)]
        rows += [(2 * i, " ".join(shared + own)), (2 * i + 1, " ".join(shared + own[:-1] + [word()]))]
    got = run(spark, rows)
    assert got == classes(rows) == {i: i - i % 2 for i in range(120)}


def test_defined_cases(spark):
    long = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3000
    rows = [(1, None), (2, ""), (3, ""), (4, "!!!"), (5, "!!!"), (6, "?"), (7, "one two"), (8, "One, two"), (9, "two one"), (11, long), (10, long), (12, long + "x")]
    got = run(spark, rows)
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, 9: 9, 10: 10, 11: 10, 12: 10}
    df = spark.createDataFrame([(1, "same text here"), (1, "same text here"), (None, "same text here"), (None, "alone")], "doc_id long, text string")
    out = sorted((r.doc_id or 0, r.class_id or 0, r.kept) for r in dm.near_duplicates(df).collect())
    assert out == [(0, 0, True), (0, 1, False), (1, 1, True), (1, 1, True)]
    assert dm.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
