"""Operator 12: target-distribution importance resampling by bit-sliced aggregation.

Features of a text are its runs of one to ``MAX_WORDS`` consecutive words, hashed into ``BUCKETS`` buckets.  A document's
bucket counts are written as bit planes: plane j has one bit for each bucket, bit j of that bucket's count.  The corpus
totals are sums of plane bits times powers of two.  The gain of a bucket, the rounded log ratio of its smoothed shares in
target and corpus, is sliced the same way into planes of its positive and of its negative part.  A document's weight is

    sum over j, k of 2**(j + k) * (popcount(plane j & positive plane k) - popcount(plane j & negative plane k)),

exactly the sum of the gains over its features, in integers.  The draw without replacement takes the highest scores, each
being the weight plus Gumbel noise from a hash of the id.

Texts are never sampled or cut.  Words, their CRCs and those of their runs are computed on whole arrays of bytes; the CRC
of a run follows from those of its parts, as the CRC of two joined strings is a linear function of theirs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metassoc.llm.common import staged
from metassoc.operators.ranks import row_index
from metassoc.session import prepare

BUCKETS = 10000
MAX_WORDS = 3
MIN_WORDS = 20                # a shorter document is not drawn
PERCENT = 5
SEED = 42
SCALE = 1000                  # gains and noise are thousandths of a nat
PLANE = -(-BUCKETS // 64) * 8           # bytes of a plane, whole 64-bit words
BLOCK_BYTES = 2_000_000       # of text, or one document
BLOCK_DOCS = 256
RUN = 64                      # words and shifts up to this length go by table

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, bool)
for _a, _b in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    IS_WORD[_a:_b + 1] = True


# --- CRCs of words and of runs of words ---------------------------------------------------------------------------------

@cache
def _byte_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


def _zero_byte(c: np.ndarray) -> np.ndarray:
    return _byte_table()[c & 255] ^ (c >> 8)


@cache
def _shift_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """[length][byte place][value]: that byte of a CRC, ``length`` zero bytes later; and the same for lengths 2**k."""
    t = np.empty((RUN + 1, 4, 256), np.uint32)
    t[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for i in range(RUN):
        t[i + 1] = _zero_byte(t[i])
    powers = [t[1]]
    for _ in range(30):
        powers.append(_apply(powers[-1], powers[-1]))
    return t, powers


def _apply(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    return table[0][c & 255] ^ table[1][(c >> 8) & 255] ^ table[2][(c >> 16) & 255] ^ table[3][c >> 24]


def shifted(c: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRCs ``c`` moved on by as many zero bytes as ``length`` says: crc(a + b) == shifted(crc(a), len(b)) ^ crc(b)."""
    tables, powers = _shift_tables()
    short = np.minimum(length, RUN)
    out = (tables[short, 0, c & 255] ^ tables[short, 1, (c >> 8) & 255] ^ tables[short, 2, (c >> 16) & 255] ^ tables[short, 3, c >> 24])
    far = np.flatnonzero(length > RUN)
    if len(far):
        left, moved = length[far], c[far]
        for k, table in enumerate(powers):
            odd = (left >> k) & 1 == 1
            moved[odd] = _apply(table, moved[odd])
        out[far] = moved
    return out


def word_crcs(data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(CRC, length, start) of the words of ``data``, bytes in lower case; no word goes over a place in ``firsts``."""
    flag = np.zeros(len(data) + 1, bool)
    flag[:-1] = IS_WORD[data]
    new = np.zeros(len(data) + 1, bool)
    new[0] = new[firsts] = True
    start = np.flatnonzero(flag & (new | ~np.concatenate(([False], flag[:-1]))))
    end = np.flatnonzero(flag[:-1] & (new[1:] | ~flag[1:])) + 1
    length = end - start
    order = np.argsort(np.minimum(length, RUN + 1).astype(np.uint8), kind="stable")[::-1]
    at, sizes = start[order], length[order]
    crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
    table, more = _byte_table(), len(at) - np.cumsum(np.bincount(np.minimum(sizes, RUN + 1), minlength=RUN + 2))
    for i in range(RUN):
        m = int(more[i])                 # words longer than i bytes come first
        if m == 0:
            break
        c = crc[:m]
        crc[:m] = table[(c ^ data[at[:m] + i]) & 255] ^ (c >> 8)
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(int(more[RUN])):
        crc[i] = zlib.crc32(data[at[i]:at[i] + sizes[i]])
    out = np.empty_like(crc)
    out[order] = crc
    return out, length, start


def _whole(data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``word_crcs``, a long text being cut between words so that working memory stays bounded."""
    if len(data) <= 2 * BLOCK_BYTES:
        return word_crcs(LOWER[data], firsts)
    parts, lo = [], 0
    while lo < len(data):
        hi = min(lo + BLOCK_BYTES, len(data))
        while hi < len(data) and IS_WORD[LOWER[data[hi]]]:
            hi += 1
        here = firsts[(firsts >= lo) & (firsts < hi)] - lo
        crc, length, start = word_crcs(LOWER[data[lo:hi]], here)
        parts.append((crc, length.astype(np.int32), start + lo))
        lo = hi
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def bucket_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words of each document, counts[document, bucket]) of the documents ``data[offsets[i]:offsets[i + 1]]``."""
    n = len(offsets) - 1
    crc, length, start = _whole(data, offsets[:-1])
    doc = np.searchsorted(offsets, start, "right") - 1
    counts = np.zeros(n * BUCKETS, np.int64)
    space = np.uint32(zlib.crc32(b" "))
    one = np.ones(1, np.int64)
    for lo in range(0, len(crc), BLOCK_BYTES):
        hi = min(lo + BLOCK_BYTES, len(crc))
        run, alive = crc[lo:hi], np.arange(lo, hi)
        counts += np.bincount(doc[alive] * BUCKETS + run % BUCKETS, minlength=len(counts))
        for more in range(1, MAX_WORDS):
            inside = alive + more < len(crc)
            alive, run = alive[inside], run[inside]
            same = doc[alive + more] == doc[alive]
            alive, run = alive[same], run[same]
            after = alive + more
            run = shifted(shifted(run, np.broadcast_to(one, run.shape)) ^ space, length[after]) ^ crc[after]
            counts += np.bincount(doc[alive] * BUCKETS + run % BUCKETS, minlength=len(counts))
    return np.bincount(doc, minlength=n), counts.reshape(n, BUCKETS)


# --- bit planes -----------------------------------------------------------------------------------------------------------

def planes(values: np.ndarray) -> np.ndarray:
    """(rows, bits, PLANE) bytes: bit planes of non-negative integers (rows, BUCKETS)."""
    bits = int(values.max(initial=0)).bit_length()
    out = np.zeros((len(values), bits, PLANE), np.uint8)
    for j in range(bits):
        out[:, j, :-(-BUCKETS // 8)] = np.packbits((values >> j & 1).astype(bool), axis=1, bitorder="little")
    return out


def sliced(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, planes binary) per row, written to the shared folder: the bit planes of the bucket counts, one
    after another, as many as the largest count needs.

    Null and empty texts, and texts without a word, have no plane; repeated rows and null ids are kept; other columns are
    not read; an empty table gives no rows."""
    spark = prepare(df.sparkSession)
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_features", T.LongType()), T.StructField("planes", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(1).cast(pa.large_string()).fill_null("").cast(pa.large_binary())
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
            data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
            lo = 0
            while lo < len(text):
                hi = lo + 1
                while hi < len(text) and hi - lo < BLOCK_DOCS and offsets[hi + 1] - offsets[lo] <= BLOCK_BYTES:
                    hi += 1
                words, counts = bucket_counts(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                need = [int(x).bit_length() for x in counts.max(axis=1)]
                all_planes = planes(counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(words), pa.array(counts.sum(axis=1)),
                     pa.array([p[:k].tobytes() for p, k in zip(all_planes, need, strict=True)], pa.binary())], names=schema.names)
                lo = hi

    return staged(df.select(id_col, text_col).mapInArrow(run, schema), "planes")


def _rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(planes, document of each, its place in the document)"""
    raw = column.to_pylist()
    n = np.array([len(x) // PLANE for x in raw], np.int64)
    rows = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, PLANE)
    return rows, np.repeat(np.arange(len(n)), n), np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)


def bucket_totals(slices: DataFrame) -> np.ndarray:
    """Counts of all documents by bucket: summed in each partition first, so ``BUCKETS`` rows leave a task and reach the driver."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            rows, _, place = _rows_of(batch.column(0))
            for j in range(int(place.max(initial=-1)) + 1):
                here = rows[place == j]
                for lo in range(0, len(here), 1024):
                    total += np.unpackbits(here[lo:lo + 1024], axis=1, count=BUCKETS, bitorder="little").sum(axis=0, dtype=np.int64) << j
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in slices.select("planes").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(SCALE * log ratio) of the smoothed shares of every bucket."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    return np.floor(SCALE * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weigh(slices: DataFrame, gain: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight): planes of the counts against planes of the gains."""
    signs = [(sign, planes(np.maximum(sign * gain, 0)[None, :])[0].view(np.uint64)) for sign in (1, -1)]
    schema = T.StructType([*slices.schema.fields[:3], T.StructField("weight", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, doc, place = _rows_of(batch.column(3))
            weight = np.zeros(batch.num_rows, np.int64)
            for lo in range(0, len(rows), 512):
                part, total = rows[lo:lo + 512].view(np.uint64), np.zeros(len(rows[lo:lo + 512]), np.int64)
                for sign, bits in signs:
                    for k, plane in enumerate(bits):
                        total += sign * (np.bitwise_count(part & plane).sum(axis=1, dtype=np.int64) << k)
                np.add.at(weight, doc[lo:lo + 512], total << place[lo:lo + 512])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight)], names=schema.names)

    return slices.mapInArrow(run, schema)


def noise(id_col: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, by a hash of the id; null for a null id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_col.cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-F.lit(float(SCALE)) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_id: str = "item_id",
               target_text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """(id_col, n_features, weight, score, rank): ``rank`` counts the drawn documents from 1, ``percent`` in a hundred of those of
    ``min_words`` words and more, highest score first, ties to the smaller id; null for the others.

    A null id has no score and is not drawn nor counted; repeated rows take part one by one; an empty target gives each
    bucket the same share; an empty corpus gives no rows.  Ranks come from a global sort over ranges, not from one task."""
    slices = sliced(docs, id_col, text_col)
    gain = gains(bucket_totals(slices), bucket_totals(sliced(target, target_id, target_text)))
    found = staged(weigh(slices, gain).withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "weights")
    able = F.coalesce((F.col("n_words") >= min_words) & F.col("id").isNotNull(), F.lit(False))
    many = percent * found.where(able).count() // 100
    ranked = row_index(found.where(able).orderBy(F.desc("score"), "id"), "at")
    rank = F.when(F.col("at") < many, F.col("at") + 1).cast("long")
    out = ranked.withColumn("rank", rank).drop("at").unionByName(found.where(~able).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The documents drawn, with all their columns."""
    drawn = importance(docs, target, id_col, **how).where("rank IS NOT NULL").select(F.col(id_col).alias("__drawn_id"))
    return docs.join(drawn, docs[id_col] == F.col("__drawn_id"), "left_semi")
