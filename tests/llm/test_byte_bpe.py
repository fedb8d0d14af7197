"""Merge replay against the tiktoken library, and the decode round trip."""

import random

import numpy as np
import public_tokenizers
import regex
import tiktoken

from metassoc.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def reference():
    with open(PATH, "rb") as f:
        ranks = byte_bpe.parse_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    alphabet = "ab aéß́漢字🙂\n\t\x1c\x85\xa0   's'll12٣²Ⅷ.,!"
    odd = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return [None, "", "a" * 5000, "ab" * 3000, "<|endoftext|>", "the " * 3000, *odd, odd[0], odd[0]]


def test_whole_texts_match_the_library(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", byte_bpe.F.lit("clash"))
    out = byte_bpe.decode(byte_bpe.encode(df, PATH, public_tokenizers.PATTERN, block_chars=500, cache_words=50), PATH)
    got = {r.doc_id: r for r in out.collect()}
    enc = reference()
    assert len(got) == len(rows)
    for i, t in rows:
        assert got[i].ids == enc.encode_ordinary(t or "")
        assert bytes(got[i].decoded) == (t or "").encode()


def test_low_rank_pairs_that_appear_late_come_first():
    # merging "bc" makes "abc" possible, whose rank is lower than that of "bc" itself
    ranks = {bytes([i]): i for i in range(256)} | {b"abc": 256, b"bc": 257, b"aa": 258, b"bcbc": 259}
    enc = tiktoken.Encoding("x", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    replay = byte_bpe.MergeReplay(ranks)
    assert replay.unsafe[257]
    rng = random.Random(0)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(500)]
    ids, size = replay.encode_words([w.encode() for w in words])
    for w, part in zip(words, np.split(ids, np.cumsum(size)[:-1]), strict=True):
        assert part.tolist() == enc.encode_ordinary(w)


def test_empty_table_and_null_ids(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.encode(df, PATH, public_tokenizers.PATTERN).count() == 0
    df = spark.createDataFrame([(1, None), (None, [72, 105])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in byte_bpe.decode(df, PATH).collect()}
    assert got[1] is None and bytes(got[None]) == byte_bpe.MergeReplay.decode(
        byte_bpe.replay_of(open(PATH, "rb").read()), np.array([72, 105]))[0].tobytes()


def test_split_pattern_keeps_every_character():
    for t in texts():
        assert "".join(regex.findall(public_tokenizers.PATTERN, t or "")) == (t or "")
