"""The pipeline against plain versions of its stages."""

import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from metassoc.llm import language, packing
from .test_dartminhash import classes
from .test_secret_scan import brute

SF = "/root/testdata/sf0.001"


def redacted(text):
    at, out = 0, ""
    for a, _, b, _ in brute(text):
        if a >= at:
            out += text[at:a] + "[REDACTED]"
        at = max(at, b)
    return out + text[at:]


def test_run_matches_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = language.fit(docs)
    lang, score = language.Scorer(model).predict(list(rows.values()))
    kept = {i: t for (i, t), p, s in zip(rows.items(), lang, score, strict=True) if p != "und" and s >= 0.5}
    of = classes(list(kept.items()))
    kept = {i: redacted(t) for i, t in kept.items() if of[i] == i}
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: [*lib.encode(t, add_special_tokens=False).ids, 1] for i, t in kept.items()}
    got = {}
    pieces = corpus_pipeline.run(spark, SF).collect()
    for p in sorted(pieces, key=lambda p: p.start):
        assert p.start == len(got.setdefault(p.doc_id, []))
        got[p.doc_id] += p.ids
    assert got == want
    total = sum(map(len, want.values()))
    assert {p.sequence_id for p in pieces} == set(range(-(-total // packing.LENGTH)))


def test_stages_on_awkward_documents(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    text = "the quick brown fox jumps over the lazy dog and runs away from the angry bear"
    rows = [(1, text, "en", "s", 77), (1, text, "en", "s", 77), (2, text + " now", "en", "s", 81), (3, None, "en", "s", None), (4, "", "fr", None, 0),
            (5, "123 !!", None, "s", 6), (None, text, None, None, 77), (6, "token = abcdef123 is what the bear said to the fox", "en", "s", 50)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), name)
        assert docs.columns == schema.names
        empty = stage(spark, spark.createDataFrame([], schema), SF)
        assert empty.columns == schema.names and empty.count() == 0
    left = sorted((r.text, r.n_chars) for r in docs.collect())
    assert len(left) == 2 and left[1][0].startswith("the quick") and left[0] == ("[REDACTED] is what the bear said to the fox", 43)
    assert corpus_pipeline.pack(spark, docs, SF).count() == 2


def test_foreign_texts_and_gibberish_are_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    foreign = ["Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita e quanto a dir qual era e cosa dura",
               "Litwo ojczyzno moja ty jestes jak zdrowie ile cie trzeba cenic ten tylko sie dowie kto cie stracil dzis pieknosc twa w calej ozdobie widze"]
    foreign += [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(60)) for _ in range(20)]
    foreign += [" ".join("%08x" % rng.getrandbits(32) for _ in range(60)) for _ in range(20)]
    short = "Nel mezzo del cammin di nostra vita"
    planted = spark.createDataFrame([(10**9 + i, t, None, "s", len(t)) for i, t in enumerate([*foreign, short])], docs.schema)
    model = language.fit(docs)
    _, score = language.Scorer(model).predict(foreign)
    assert (score >= corpus_pipeline.MIN_SCORE).all()                  # the posterior alone rejects none of them
    left = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.union(planted), SF).collect()}
    assert not left & {10**9 + i for i in range(len(foreign))}
    assert left - {10**9 + len(foreign)} == {r.doc_id for r in language.predict(docs, model).where("score >= 0.5").collect()}


def test_different_texts_under_one_id_are_different_documents(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    a, b, c = ("the quick brown fox jumps over the lazy dog", "a storm came in from the sea and took the boats", "nobody knew who had written the letter at all")
    rows = [(1, a), (2, a), (2, b), (2, b), (3, b), (5, c), (5, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 40) for i, t in rows], schema)
    left = [r.text for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()]
    assert sorted(left, key=str) == sorted([a, b, c, None], key=str)
