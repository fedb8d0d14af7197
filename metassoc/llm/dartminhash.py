"""Operator 5: near-duplicate documents by DartMinHash signatures, banded joining and exact verification.

An element is a shingle of five words; its weight is the number of its occurrences.  The region of an element is
[0, weight) x [0, limit): a Poisson stream of darts, hashed from element and unit strip, falls along each unit of weight
(a fractional last unit keeps the darts whose hashed place lies inside it).  The limit is set so that a document catches
about k ln k + 2k darts, however long it is; a dart is hashed to one of k coordinates, and the earliest dart of each
coordinate is the signature.  A document with an empty coordinate doubles its limit.  Two documents agree in a coordinate
with a probability of their weighted Jaccard similarity.

Joining: the k coordinates form bands.  The documents of a bucket (equal band) are not paired with one another: each
bucket yields a spanning forest of greatest estimated similarity, taken from the signatures, so there are fewer pairs
than documents in it.  Its pairs are verified on the whole shingle multisets, the best pair of every document first, then
those still between components.  A forest of greatest similarity connects whatever any pairs above a bound connect, but
estimates have errors: documents of buckets that then still hold several components meet once more with their shingle
multisets, and every pair between components that could be similar is verified inside the task, which returns only links
found.  Large buckets are dealt out in pairs of blocks.  Exact copies are one node all along.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metassoc.llm.common import components, lean, lean_group, staged
from metassoc.llm.wordcache import blocks
from metassoc.session import prepare

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
BLOCK_CHARS = 500_000
PAIR_BLOCK = 2048                # documents of a bucket compared with as many others in one block
GROUP_ROWS = 20_000              # bucket entries in one group of buckets, on average
SIGMAS = 4                       # standard deviations by which an estimate may fall short of the threshold
U64 = np.uint64

words_of = re.compile(r"\w+").findall


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply and shift), elementwise."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((x >> U64(11)).astype(np.float64) + 1.0) * 2.0**-53


def shingles(docs: list[list[str]], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(document, 64-bit shingle) of every occurrence; a document of fewer than n words has its words as one shingle."""
    import xxhash
    known = {w: xxhash.xxh64_intdigest(w) for w in {w for words in docs for w in words}}
    size = np.fromiter(map(len, docs), np.int64, len(docs))
    h = np.fromiter((known[w] for words in docs for w in words), U64, int(size.sum()))
    doc = np.repeat(np.arange(len(docs)), size)
    first = np.cumsum(size) - size
    left = (first + size)[doc] - np.arange(len(h))          # words from here to the end of the document
    long = size >= n
    at = np.flatnonzero(long[doc] & (left >= n))
    got = np.full(len(at), 0x9E3779B97F4A7C15, U64)
    for i in range(n):
        got = mix(got * U64(0xD1342543DE82EF95) + h[at + i])
    short = np.flatnonzero(~long & (size > 0))
    few = size[short].astype(U64)
    for i in range(n - 1):
        on = size[short] > i
        few[on] = mix(few[on] * U64(0xD1342543DE82EF95) + h[first[short[on]] + i])
    return np.concatenate((doc[at], short)), np.concatenate((got, few))


def strips(doc: np.ndarray, element: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) of the unit strips of every region: the j-th occurrence of an element is its j-th unit of weight."""
    order = np.lexsort((element, doc))
    doc, element = doc[order], element[order]
    i = np.arange(len(doc))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (element[1:] != element[:-1])
    j = i - np.maximum.accumulate(np.where(new, i, 0))
    return doc, mix(element + j.astype(U64) * U64(0x9E3779B97F4A7C15))


def throw(doc: np.ndarray, key: np.ndarray, limit: np.ndarray, part: np.ndarray | None = None):
    """Darts (document, hash, rank) with a rank below the document's limit, strip by strip in order of rank."""
    out_doc, out_hash, out_rank = [], [], []
    rank, t = np.zeros(len(key)), 0
    while len(key):
        h = mix(key + U64((2 * t + 1) * 0xA0761D6478BD642F & (2**64 - 1)))
        rank = rank - np.log(uniform(h))
        on = rank < limit[doc]
        doc, key, rank, h = doc[on], key[on], rank[on], h[on]
        part = part[on] if part is not None else None
        dart = mix(h ^ U64(0xE7037ED1A0B428DB))
        inside = slice(None) if part is None else uniform(mix(dart + U64(1))) <= part
        out_doc.append(doc[inside])
        out_hash.append(dart[inside])
        out_rank.append(rank[inside])
        t += 1
    cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return cat(out_doc, np.int64), cat(out_hash, U64), cat(out_rank, float)


def signatures(n_docs: int, doc: np.ndarray, key: np.ndarray, k: int = BANDS * ROWS, part: np.ndarray | None = None) -> np.ndarray:
    """n_docs x k dart hashes; a row of zeros for a document without strips.

    ``part``: width of each strip where it is a fractional last unit of weight, else 1."""
    out = np.zeros((n_docs, k), U64)
    weight = np.bincount(doc, part, minlength=n_docs)
    todo = weight > 0
    limit = (k * np.log(k) + 2 * k) / np.where(todo, weight, 1)
    while todo.any():
        on = todo[doc]
        d, h, r = throw(doc[on], key[on], limit, part[on] if part is not None else None)
        cell = d * k + (h % U64(k)).astype(np.int64)
        order = np.argsort(-r, kind="stable")
        best = np.zeros(n_docs * k, U64)
        hit = np.zeros(n_docs * k, bool)
        best[cell[order]] = h[order]          # the last one written is the earliest dart
        hit[cell] = True
        full = todo & hit.reshape(n_docs, k).all(axis=1)
        out[full] = best.reshape(n_docs, k)[full]
        todo &= ~full
        limit = limit * 2
    return out


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = np.zeros((len(sig), bands), U64)
    for i in range(rows):
        out = mix(out * U64(0xD1342543DE82EF95) + sig[:, i:bands * rows:rows])
    return out


def _sign(df: DataFrame) -> DataFrame:
    """(key, sig, bands) of the texts that have words; copies within a batch are signed once.

    sig: the lowest byte of every coordinate, for estimates."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            once = {k: t for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)}
            keys, texts = list(once), list(once.values())
            for lo, hi in blocks(texts, BLOCK_CHARS):
                docs = [words_of(t.lower()) for t in texts[lo:hi]]
                doc, key = strips(*shingles(docs))
                sig = signatures(hi - lo, doc, key)
                some = [i for i, words in enumerate(docs) if words]
                if not some:
                    continue
                band = band_keys(sig[some]).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys[lo + i] for i in some], pa.binary()),
                    pa.array([x.tobytes() for x in (sig[some] & U64(255)).astype(np.uint8)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * BANDS), pa.array(band.ravel()))],
                    names=["key", "sig", "bands"])

    return df.mapInArrow(lean(run), "key binary, sig binary, bands array<long>")


def _shingle_sets(df: DataFrame) -> DataFrame:
    """(key, strips): the shingle multiset of a text as the set of its strips, 32 bits each."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in blocks(texts, BLOCK_CHARS):
                doc, key = strips(*shingles([words_of(t.lower()) for t in texts[lo:hi]]))
                ends = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo), pa.ListArray.from_arrays(
                    pa.array(ends), pa.array((key >> U64(32)).astype(np.uint32).view(np.int32)))], names=["key", "strips"])

    return df.mapInArrow(lean(run), "key binary, strips array<int>")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity reaches the threshold."""
    both = (pairs.join(sets.select(F.col("key").alias("a"), F.col("strips").alias("x")), "a")
            .join(sets.select(F.col("key").alias("b"), F.col("strips").alias("y")), "b"))
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(shared >= threshold * (F.size("x") + F.size("y") - shared)).select("a", "b")


def spanning_forest(sig: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(row, row, equal coordinates) of a forest of greatest agreement, without pairs of less than ``least``."""
    n = len(sig)
    best, source, done = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, bool)
    out = []
    for _ in range(n):
        y = int(np.where(done, -2, best).argmax())
        if best[y] >= least:
            out.append((int(source[y]), y, int(best[y])))
        done[y] = True
        same = (sig == sig[y]).sum(axis=1)
        better = ~done & (same > best)
        best[better], source[better] = same[better], y
    return out


def least_equal(threshold: float) -> int:
    """Equal coordinates below which two signatures do not belong to similar documents, but for ``SIGMAS`` of chance."""
    k = BANDS * ROWS
    return int(np.floor(k * (threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) / k))))


def _dealt(rows: DataFrame, n_rows: int, group_rows: int, *columns: str) -> DataFrame:
    """Bucket entries (band, value, n, key, ...) with their group g and, in large buckets, pair of blocks (i, j)."""
    parts = F.ceil(F.col("n") / PAIR_BLOCK).cast("int")
    # a pair of blocks holds both blocks whole, so one pair of different blocks also covers the pairs inside each
    mine = F.pmod(F.xxhash64("key"), F.col("p")).cast("int")
    others = F.when(F.col("p") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("p") - 1), lambda o: o != F.col("m")))
    groups = max(1, n_rows // group_rows)
    place = F.when(F.col("p") == 1, F.pmod(F.xxhash64("band", "value"), F.lit(groups))).otherwise(
        -1 - F.pmod(F.xxhash64("band", "value", "i", "j"), F.lit(1 << 40)))
    return (rows.withColumn("p", parts).withColumn("m", mine).withColumn("o", F.explode(others))
            .withColumn("i", F.least("m", "o")).withColumn("j", F.greatest("m", "o"))
            .select(place.alias("g"), "band", "value", "i", "j", "key", *columns))


def _runs(group: pa.Table) -> list[np.ndarray]:
    """Row numbers of every bucket, or pair of blocks of one, in a group."""
    cols = [group[c].to_numpy() for c in ("j", "i", "value", "band")]
    order = np.lexsort(cols)
    return np.split(order, np.flatnonzero(np.any([np.diff(c[order]) != 0 for c in cols], axis=0)) + 1)


def _forest_pairs(rows: DataFrame, n_rows: int, threshold: float) -> DataFrame:
    """(a, b, est) of the forests of all buckets; rows: (band, value, n, key, sig), n documents in the bucket."""
    k, least = BANDS * ROWS, least_equal(threshold)

    def run(group: pa.Table) -> pa.Table:
        sig = np.frombuffer(b"".join(group["sig"].to_pylist()), np.uint8).reshape(-1, k)
        key = group["key"].to_pylist()
        found: dict[tuple[bytes, bytes], int] = {}
        for part in _runs(group):
            for x, y, est in spanning_forest(sig[part], least):
                a, b = key[part[x]], key[part[y]]
                found[(a, b) if a < b else (b, a)] = est
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary()),
                         "est": pa.array(list(found.values()), pa.int32())})

    return _dealt(rows, n_rows, GROUP_ROWS, "sig").groupBy("g").applyInArrow(lean_group(run), "a binary, b binary, est int").distinct()


def cross_links(sig: np.ndarray, bands: np.ndarray, band: int, label: np.ndarray, sets: list[np.ndarray], least: int,
                threshold: float) -> list[tuple[int, int]]:
    """Verified links between rows of different labels, joining labels on the way; a pair that also shares an earlier band
    is left to that one."""
    label, out = label.copy(), []
    for x in range(len(sig) - 1):
        rest = np.arange(x + 1, len(sig))
        rest = rest[label[rest] != label[x]]
        same = (sig[rest] == sig[x]).sum(axis=1)
        rest, same = rest[same >= least], same[same >= least]
        if band and len(rest):
            new = ~(bands[rest, :band] == bands[x, :band]).any(axis=1)
            rest, same = rest[new], same[new]
        for y in rest[np.argsort(-same, kind="stable")].tolist():
            if label[x] == label[y]:
                continue
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if both >= threshold * (len(sets[x]) + len(sets[y]) - both):
                out.append((x, y))
                label[label == label[y]] = label[x]
    return out


def _cross_links(rows: DataFrame, n_rows: int, threshold: float) -> DataFrame:
    """(a, b) of ``cross_links`` in all buckets; rows: (band, value, n, key, sig, bands, label, strips)."""
    k, least = BANDS * ROWS, least_equal(threshold)

    def run(group: pa.Table) -> pa.Table:
        sig = np.frombuffer(b"".join(group["sig"].to_pylist()), np.uint8).reshape(-1, k)
        bands = group["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        key, names = group["key"].to_pylist(), {}
        label = np.array([names.setdefault(x, len(names)) for x in group["label"].to_pylist()])
        strip, band = group["strips"].combine_chunks(), group["band"].to_numpy()
        found = set()
        for part in _runs(group):
            if len(np.unique(label[part])) > 1:
                sets = [np.unique(strip[int(r)].values.to_numpy()) for r in part]
                for x, y in cross_links(sig[part], bands[part], int(band[part[0]]), label[part], sets, least, threshold):
                    a, b = key[part[x]], key[part[y]]
                    found.add((a, b) if a < b else (b, a))
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    dealt = _dealt(rows, n_rows, GROUP_ROWS // 4, "sig", "bands", "label", "strips")
    return dealt.groupBy("g").applyInArrow(lean_group(run), "a binary, b binary").distinct()


def _links(signed: DataFrame, texts: DataFrame, reps: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(verified pairs, components of their nodes); see the head of this module."""
    buckets = signed.select("key", F.posexplode("bands").alias("band", "value"))
    shared = buckets.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    member = staged(buckets.join(shared, ["band", "value"]), "buckets")
    forest = staged(_forest_pairs(member.join(signed.select("key", "sig"), "key"), member.count(), threshold), "forest")
    # a document with any partner that may be similar is in the forest, so these are all the texts ever verified
    need = forest.select(F.col("a").alias("key")).union(forest.select("b")).distinct().join(reps.select("key", "uid"), "key")
    sets = staged(_shingle_sets(texts.join(need, ["key", "uid"]).select("key", "text")).dropDuplicates(["key"]), "shingles")
    ends = forest.select(F.col("a").alias("x"), F.col("b").alias("y"), "est").union(forest.select("b", "a", "est"))
    pairs = ends.groupBy("x").agg(F.max(F.struct("est", "y")).alias("best")).select(
        F.least("x", "best.y").alias("a"), F.greatest("x", "best.y").alias("b")).distinct()
    links = staged(_verified(staged(pairs, "pairs"), sets, threshold), "links")
    label = staged(components(links), "labels")

    def named(c):
        return label.select(F.col("node").alias(c), F.col("component").alias(f"{c}_of"))

    apart = F.coalesce("a_of", "a") != F.coalesce("b_of", "b")
    pairs = forest.select("a", "b").join(named("a"), "a", "left").join(named("b"), "b", "left").where(apart).select("a", "b")
    links = links.union(staged(_verified(staged(pairs.join(links, ["a", "b"], "left_anti"), "pairs"), sets, threshold), "links"))
    label = staged(components(links), "labels")
    now = (member.join(need.select("key"), "key").join(named("key"), "key", "left")
           .withColumn("label", F.coalesce("key_of", "key")).drop("key_of"))
    mixed = now.groupBy("band", "value").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi")
    # buckets of two documents have had their only pair in the forest
    rest = staged(now.where("n > 2").join(mixed.select("band", "value"), ["band", "value"]), "rest")
    rows = rest.join(signed.select("key", "sig", "bands"), "key").join(sets, "key")
    more = staged(_cross_links(rows, rest.count(), threshold), "links")
    links = links.union(more)
    return links, staged(components(links), "labels")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, class_id, kept) for every row: class_id is the smallest id among the documents linked with it, directly or
    through others, by equal texts or by a weighted Jaccard similarity of five-word shingles of ``threshold`` or more.

    Words are runs of letters, digits and underscores in lower case.  A text of one to four words is one shingle.  A null or empty
    text is alone in its class; texts without words are linked by being equal only.  kept: the id is the class id.
    Repeated rows get equal results; null ids do not count as smallest (a class of null ids has a null class_id and is
    kept); other columns are not read; an empty table gives no rows."""
    prepare(df.sparkSession)
    md5 = F.unhex(F.md5(F.col("text").cast("binary")))
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = docs.where(F.col("text") != "").withColumn("key", md5).withColumn("uid", F.coalesce("id", F.xxhash64("text")))
    reps = staged(texts.groupBy("key").agg(F.min("uid").alias("uid"), F.min("id").alias("id")), "nodes")
    signed = staged(_sign(texts.select("key", "text")).dropDuplicates(["key"]), "signatures")
    _, label = _links(signed, texts, reps, threshold)
    nodes = reps.join(label.withColumnRenamed("node", "key"), "key", "left")
    least = nodes.where("component is not null").groupBy("component").agg(F.min("id").alias("least"))
    classes = nodes.join(least, "component", "left").select("key", F.coalesce("least", "id").alias("class_id"))
    keyed = docs.select("id", F.when(F.col("text") != "", md5).alias("key"))
    found = keyed.where("key is not null").join(classes, "key", "left").select("id", "class_id").union(
        keyed.where("key is null").select("id", F.col("id").alias("class_id")))
    return found.select(F.col("id").alias(id_col), "class_id", F.coalesce(F.col("id") == F.col("class_id"), F.col("class_id").isNull()).alias("kept"))
