"""Importance resampling against dictionaries of features."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from metassoc.llm import bit_slices as bs

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return len(words), [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def buckets(text):
    return Counter(zlib.crc32(f.encode()) % 10000 for f in features(text)[1])


def plain(docs, target, percent=5):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(buckets(x))
    for x in target:
        t.update(buckets(x))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    rows, able = [], []
    for k, (i, x) in enumerate(docs):
        n, f = features(x)
        weight = sum(gain[b] * c for b, c in buckets(x).items())
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n >= 20:
                able.append((-score, i, k))
        rows.append([i, len(f), weight, score, None])
    for r, (_, _, k) in enumerate(sorted(able)[:percent * len(able) // 100]):
        rows[k][4] = r + 1
    return rows


def texts():
    rng = random.Random(2)
    words = ["The", "a", "été", "ÀB", "x1", "漢字", "🙂", "w" * 64, "v" * 65, "u" * 300, "of", "land", "Thing"]
    made = ["".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "@", "\x7f", "`"]) for _ in range(rng.randint(0, 90))) for _ in range(160)]
    return [None, "", " .,;", "a", "a " * 30_000, "z" * 5000 + " " + "é" * 4000, *made, made[0], made[0]]


def test_crcs_of_runs():
    text = " ".join(t for t in texts() if t).lower().encode()
    data = np.frombuffer(text, np.uint8)
    crc, length, start = bs.word_crcs(data, np.array([0]))
    assert [zlib.crc32(text[a:a + n]) for a, n in zip(start, length, strict=True)] == crc.tolist()
    joined = bs.shifted(crc[:-1], length[1:]) ^ crc[1:]
    assert [zlib.crc32(text[a:a + m] + text[b:b + n]) for a, m, b, n in zip(start, length, start[1:], length[1:], strict=False)] == joined.tolist()


def test_weights_and_draw(spark):
    docs = [*enumerate(texts()), (None, "word " * 50), (3, "land of the thing " * 9), (3, "land of the thing " * 9)]
    target = ["land of the Thing", None, "été land", "x1 x1 x1"]
    df = spark.createDataFrame([(i, x, "clash", 1) for i, x in docs], "doc_id long, text string, id string, weight int").repartition(3)
    aim = spark.createDataFrame([(k, x) for k, x in enumerate(target)], "item_id long, text string")
    key = lambda r: tuple(str(x) for x in r)
    for percent in (5, 60):
        got = bs.importance(df, aim, percent=percent).collect()
        assert sorted(map(key, got)) == sorted(map(key, plain(docs, target, percent)))
    drawn = bs.resample(df, aim, percent=60)
    assert drawn.columns == df.columns
    assert {r.doc_id for r in drawn.collect()} == {r[0] for r in plain(docs, target, 60) if r[4]}


def test_long_texts_by_parts(monkeypatch):
    docs = ["été land " * 70, "", " ".join(t for t in texts() if t)]
    offsets = np.cumsum([0, *(len(t.encode()) for t in docs)])
    data = np.frombuffer("".join(docs).encode(), np.uint8)
    whole = bs.bucket_counts(data, offsets)
    monkeypatch.setattr(bs, "BLOCK_BYTES", 500)
    parts = bs.bucket_counts(data, offsets)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    for counts, t in zip(whole[1], docs, strict=True):
        assert {b: n for b, n in enumerate(counts.tolist()) if n} == buckets(t)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    aim = spark.createDataFrame([], "item_id long, text string")
    assert bs.importance(none, aim).count() == 0
    one = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert [r[1] for r in bs.importance(one, aim).collect()] == [3 * 40 - 3]
