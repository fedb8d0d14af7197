"""Back-off order, defined results, and held-out accuracy on the driver table."""

import zlib

import numpy as np
import pytest

from metassoc.llm import language
from metassoc.llm.queries import QUERIES


def test_word_first_then_longest_known_grams():
    m = language.Model(["x", "y"], [1, 1], [{"the": [9, 1]}, {"q": [0, 5]}, {"th": [4, 4]}, {"abc": [0, 8]}, {}, {}])
    assert np.allclose(m.score_word("the"), m.logs[0][0])
    assert np.allclose(m.score_word("zabc"), m.logs[3][0])        # longest known length is 3
    assert np.allclose(m.score_word("thq"), m.logs[2][0])         # 2 before 1
    assert np.allclose(m.score_word("q"), m.logs[1][0])
    assert np.allclose(m.score_word("zz"), 0)


def train(spark):
    rows = [(i, "the cat and the dog" if i % 2 else "le chat et le chien", "en" if i % 2 else "fr", 0.5) for i in range(400)]
    rows += [(1000, None, "en", 0.1), (1001, "word", None, 0.1), (None, "the", "fr", 0.1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")


def test_defined_results(spark):
    model = language.fit(train(spark))
    assert model.langs == ["en", "fr"]
    df = spark.createDataFrame([(1, None), (2, ""), (3, "123 ²!"), (4, "the dog"), (4, "the dog"), (None, "le chien " * 20000), (5, "Ça")],
                               "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.lang_pred, r.score) for r in language.predict(df, model).collect()))
    assert [(i, p) for i, p, _ in got] == [(0, "fr"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, got[-1][1])]
    assert all(0 <= s <= 1 for _, _, s in got) and got[-1][1] in ("en", "fr")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language.fit(none)
    assert language.predict(none, model).count() == 0
    df = spark.createDataFrame([(1, "the")], "doc_id long, text string")
    assert language.predict(df, model).first()[1:] == ("und", 0.0)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_held_out_accuracy(spark, sf):
    d = f"/root/testdata/{sf}"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op7_language_id"](spark, d).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.97


def test_floors_come_from_all_labelled_texts(spark):
    """3000 held-out texts of one language, each with a support of its own: the fifth percentile is that of all of them."""
    known = ["the", "cat", "and", "dog", "sat", "mat"]
    ids = [i for i in range(16000) if zlib.crc32(str(i).encode()) % 4 == 2][:3000]
    unknown = np.round(720 / np.linspace(0.3, 0.99, 3000) - 720).astype(int)
    rows = [(i, " ".join(known * 40 + ["α" * int(k)]), "en") for i, k in zip(ids, unknown, strict=True)]
    train = [(-i, " ".join(known), "en") for i in range(1, 40) if zlib.crc32(str(-i).encode()) % 4 != 2]
    df = spark.createDataFrame(rows + train, "doc_id long, text string, lang string").repartition(4)
    model = language.fit(df)
    supports = 720 / (720 + unknown)
    found = language.predict(df, model, with_support=True).where(f"doc_id IN ({ids[0]}, {ids[-1]})").orderBy("support").collect()
    assert [r.support for r in found] == pytest.approx([supports[0], supports[-1]])
    assert language.floors(df, model)["en"] == pytest.approx(language.FLOOR_SHARE * np.percentile(supports, 5), abs=1e-4)
