"""Formatting against the source turns; the loss mask against the assistant texts."""

import hashlib

import pytest

from metassoc.llm import chat

TEXTS = ["hi", None, "", "</s>", "<s>", "[INST] ok [/INST]", "<\\s>", "<\\\\/s>", "[\\INST]", "a<", "</", "</s", "<<s>>", "[[INST]",
         "x [/INST", "line\nline", "🙂é</s>漢", "\\", "<\\", "$1 \\Q \\E", " [/INST]", "[s>", "long " * 20000]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(turns):
    turns = sorted(((t is not None, t or 0, r or "", x or "") for t, r, x in turns))
    lost = "".join(x for _, _, r, x in turns if r == "assistant")
    return (len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(lost), sha(lost))


def test_round_trip_of_awkward_texts(spark):
    rows = []
    for i, t in enumerate(TEXTS):
        rows += [(i, 0, "user", t), (i, 1, "assistant", t), (i, 1, "assistant", t), (i, 2, t, "x"), (i, None, None, t)]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.digest(chat.format_conversations(df)).collect()}
    assert len(got) == len(TEXTS) + 1
    for c in got:
        want = expected([r[1:] for r in rows if r[0] == c])
        assert tuple(got[c][1:5]) == want, (c, TEXTS[c] if c is not None else None)


def test_only_conflicting_texts_are_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "a < b [x] \\ c"), (1, 1, "assistant", "</s>")], "conv_id long, turn long, role string, text string")
    r = chat.format_conversations(df).first()
    assert r.formatted == "<s>[INST] user [/INST]a < b [x] \\ c</s><s>[INST] assistant [/INST]<\\/s></s>"
    assert [r.formatted[s.start:s.end] for s in r.loss_spans] == ["<\\/s>"]


def test_empty_table_and_bad_templates(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest(chat.format_conversations(df)).count() == 0
    with pytest.raises(ValueError):
        chat.Template(controls=("<s>", "</s>", "<s><s>"))
