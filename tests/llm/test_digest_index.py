"""Exact dedup against plain grouping, in one batch and over several."""

import hashlib
import random

from metassoc.llm import digest_index as di

SCHEMA = "doc_id long, text string, digest string, id long, row string"


def sha(t):
    return hashlib.sha256((t or "").encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 5, "clash") for i, t in rows], SCHEMA)


def plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(sha(t), []).append(i)
    keep = {d: max((i for i in ids if i is not None), default=None) for d, ids in groups.items()}
    return sorted((str(i), str(keep[sha(t)]), len(groups[sha(t)]), sha(t)) for i, t in rows), keep


def test_against_plain_grouping(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "a", "A", "é", "é", "x" * 200_000, *[f"t{k}" for k in range(60)]]
    rows = [(i, "hot" if i % 3 == 0 else rng.choice(texts)) for i in range(900)]      # a third of all rows are one text
    rows += [(None, "only null ids"), (None, "only null ids"), (None, "a"), (7, "t1"), (7, "t1"), (-5, "t2")]
    got = di.exact_duplicates(frame(spark, rows).repartition(7)).collect()
    want, keep = plain(rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(keep) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == keep[r.text_sha256] for r in kept)


def test_groups_below_the_hot_share(spark, monkeypatch):
    rows = [(i, f"t{i // 4}") for i in range(400)] + [(1000 + i, "hot") for i in range(300)]
    monkeypatch.setattr(di, "HOT_SHARE", 3)
    got = di.exact_duplicates(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == plain(rows)[0]


def test_batches_append_only_what_is_new(spark):
    index = di.DigestIndex.create(spark, buckets=4)
    first = di.deduplicate(frame(spark, [(1, "a"), (2, "a"), (3, "b"), (3, "b"), (None, None)]), index)
    assert first.columns == ["doc_id", "text", "digest", "id", "row"]
    assert sorted((str(r.doc_id), r.text) for r in first.collect()) == [("2", "a"), ("3", "b"), ("None", None)]
    again = di.DigestIndex(spark, index.path, "bigint", 4)           # as another application would open it
    second = di.deduplicate(frame(spark, [(9, "a"), (10, "c"), (11, ""), (12, "c")]), again)
    assert [(r.doc_id, r.text) for r in second.collect()] == [(12, "c")]
    state = {r.digest: (r.keep_id, r.group_size) for r in again.state().collect()}
    assert state == {sha("a"): (2, 3), sha("b"): (3, 2), sha(""): (None, 2), sha("c"): (12, 2)}
    compact = again.compact()
    assert {r.digest: (r.keep_id, r.group_size) for r in compact.state().collect()} == state
    assert compact.entries().count() == len(state)


def test_the_index_is_read_by_bucket(spark):
    index = di.DigestIndex.create(spark, buckets=4)
    index.add(frame(spark, [(i, f"t{i}") for i in range(50)]))
    plan = index.state()._jdf.queryExecution().toString()
    assert "SelectedBucketsCount: 4 out of 4" in plan and "Exchange" not in plan.split("== Physical Plan ==")[1]


def test_empty_table(spark):
    assert di.exact_duplicates(frame(spark, [])).count() == 0
    index = di.DigestIndex.create(spark, buckets=2)
    assert di.deduplicate(frame(spark, []), index).count() == 0 and index.state().count() == 0
