"""Packed pieces against the tokenizers library and a plain concatenation."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from metassoc.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def texts():
    rng = random.Random(5)
    alphabet = "ab AÉß́漢字🙂\n\t\x1c\x85\xa0   's'LL12٣²Ⅷ.,!İ<|>"
    odd = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    return [None, "", "<|endoftext|> x", "A <|startoftext|>B<|ENDOFTEXT|>", "it's--'s we'LL x'd 'S \x00\x7f a1b22 ªº µ×÷ ʰ KELVIN", "<|endoftext|>", "a|><|b", "a" * 3000, "it's THE  end\n\nof  it ", "word " * 6000, *odd, odd[0], odd[0]]


def library():
    return Tokenizer.from_file(PATH)


def test_ids_and_windows(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, part int").repartition(3)
    tokens = packing.tokenize(df, PATH, block_chars=300, cache_words=40)
    lib = library()
    want = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    assert {r.doc_id: r.ids for r in tokens.collect()} == want
    length = 64
    pieces = packing.pack(tokens, length).collect()
    docs, sequences = {}, {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.doc_tokens == len(want[p.doc_id]) and p.length == len(p.ids) > 0
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        seq = sequences.setdefault(p.sequence_id, [])
        assert p.offset == len(seq)
        seq += p.ids
        docs.setdefault(p.doc_id, []).append(p)
    for i, ids in want.items():
        at = 0
        for p in sorted(docs[i], key=lambda p: p.start):
            assert p.start == at and p.ids == ids[at:at + p.length]
            at += p.length
        assert at == len(ids)
    assert sorted(sequences) == list(range(len(sequences)))
    assert all(len(sequences[k]) == length for k in sorted(sequences)[:-1]) and len(sequences[max(sequences)]) <= length
    assert {r.sequence_id: r.n_tokens for r in packing.sequences(packing.pack(tokens, length)).collect()} == {k: len(v) for k, v in sequences.items()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.tokenize(df, PATH)).count() == 0
