"""Operator 1: byte-level BPE by merge replay over a corpus of distinct words.

A block of documents is cut into words (matches of the split pattern).  The block's distinct new words form
one flat token array with links to the neighbours; an inverted index maps every token pair that has a rank
to the positions where it starts.  Merges are replayed in rank order: one merge is applied to all its
positions at once, and only the two touched neighbour pairs of each position are looked up again and indexed.
A word's ids do not depend on other words, so blocks and tasks need no exchange; the ids of words already
seen stay in a bounded cache of the worker.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metassoc.llm.wordcache import blocks, gather, worker_cache
from metassoc.session import prepare

NONE = np.int64(1 << 40)          # "this pair has no rank"
BLOCK_CHARS = 2_000_000           # characters replayed together
CACHE_WORDS = 250_000             # words whose ids a worker keeps


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    return {base64.b64decode(t): int(r) for t, r in (x.split() for x in data.splitlines() if x)}


class MergeReplay:
    """Merge tables of one vocabulary, and the replay of its merges over lists of words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.n = max(ranks.values()) + 1
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        keys, merged = [], []
        self.unsafe = np.zeros(self.n, bool)   # merging into it can create a pair of a lower rank
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a * self.n + b)
                    merged.append(r)
                    if r < a:
                        self.unsafe[a] = True
                    if r < b:
                        self.unsafe[b] = True
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.int64(1 << 62))
        self.merged = np.append(np.array(merged, np.int64)[order], NONE)
        self.token_bytes = [b""] * self.n
        for token, r in ranks.items():
            self.token_bytes[r] = token
        self.byte_len = np.array([len(t) for t in self.token_bytes], np.int64)
        self.byte_start = np.concatenate(([0], np.cumsum(self.byte_len)[:-1]))
        self.bytes_flat = np.frombuffer(b"".join(self.token_bytes), np.uint8)

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.n + b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], NONE)

    def encode_strings(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.encode_words([w.encode("utf-8", "surrogatepass") for w in words])

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per word).  A word that is a token is that token, as in the rank-file libraries."""
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int64)
        size = np.array([len(w) for w in words], np.int64)
        size[whole >= 0] = 1
        flat = np.frombuffer(b"".join(w for w, t in zip(words, whole, strict=True) if t < 0), np.uint8)
        tok = np.empty(int(size.sum()), np.int64)
        start = np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64)
        is_whole = np.zeros(len(tok), bool)
        is_whole[start[whole >= 0]] = True
        tok[is_whole] = whole[whole >= 0]
        tok[~is_whole] = self.byte_id[flat]
        alive = self._replay(tok, start, size)
        kept = np.add.reduceat(alive, start) if len(start) else np.zeros(0, np.int64)
        return tok[alive], kept

    def _replay(self, tok: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        n = len(tok)
        alive = np.ones(n, bool)
        if n < 2:
            return alive
        word = np.repeat(np.arange(len(size)), size)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[start + size - 1] = -1
        prv[start] = -1
        rank = np.full(n, NONE)
        at = np.flatnonzero(nxt >= 0)
        rank[at] = self.pair_rank(tok[at], tok[nxt[at]])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def post(positions: np.ndarray) -> None:
            r = rank[positions]
            positions, r = positions[r < NONE], r[r < NONE]
            if not len(r):
                return
            order = np.argsort(r, kind="stable")
            positions, r = positions[order], r[order]
            cuts = np.flatnonzero(np.diff(r)) + 1
            for x, part in zip(r[np.concatenate(([0], cuts))].tolist(), np.split(positions, cuts), strict=True):
                if x in index:
                    index[x].append(part)
                else:
                    index[x] = [part]
                    heapq.heappush(heap, x)

        post(at)
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            pos = parts[0] if len(parts) == 1 else np.concatenate(parts)
            pos = np.sort(pos[rank[pos] == r])
            if not len(pos):
                continue
            pos = pos[np.concatenate(([True], pos[1:] != pos[:-1]))]
            if len(pos) > 1:
                # of overlapping occurrences in a row every other one, from the left, is merged
                linked = np.concatenate(([False], nxt[pos[:-1]] == pos[1:]))
                if linked.any():
                    i = np.arange(len(pos))
                    first = np.maximum.accumulate(np.where(linked, 0, i))
                    pos = pos[(i - first) % 2 == 0]
                if self.unsafe[r]:
                    w = word[pos]
                    first = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
                    if len(first) < len(pos):     # later ones of a word wait for pairs that may now come first
                        index[r] = [np.delete(pos, first)]
                        heapq.heappush(heap, r)
                        pos = pos[first]
            gone = nxt[pos]
            after = nxt[gone]
            tok[pos] = r
            nxt[pos] = after
            alive[gone] = False
            rank[gone] = NONE
            has = after >= 0
            prv[after[has]] = pos[has]
            rank[pos] = NONE
            left = prv[pos]
            touched = np.concatenate((pos[has], left[left >= 0]))
            rank[touched] = self.pair_rank(tok[touched], tok[nxt[touched]])
            post(touched)
        return alive

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all bytes, bytes per id)"""
        size = self.byte_len[ids]
        return gather(self.bytes_flat, self.byte_start[ids], size), size


_REPLAYS: dict[bytes, MergeReplay] = {}


def replay_of(data: bytes) -> MergeReplay:
    """The worker's merge tables of a rank file, built once."""
    if data not in _REPLAYS:
        _REPLAYS.clear()
        _REPLAYS[data] = MergeReplay(parse_ranks(data))
    return _REPLAYS[data]


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           block_chars: int = BLOCK_CHARS, cache_words: int = CACHE_WORDS) -> DataFrame:
    """(id_col, ids array<int>) for every row: the byte-level BPE ids of the whole text, no special tokens.

    ``ranks_path`` is read on the driver and sent to the tasks (a vocabulary: fixed size).  A null or empty
    text has no ids; null ids and repeated rows are kept as they are; other columns are not read; an empty
    table gives an empty result."""
    spark = prepare(df.sparkSession)
    with open(ranks_path, "rb") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        cache = worker_cache(("byte", hash(vocabulary.value), cache_words), lambda: replay_of(vocabulary.value).encode_strings, cache_words)
        split = regex.compile(pattern).findall
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in blocks(texts, block_chars):
                ids, size = cache.encode([split(t) for t in texts[lo:hi]])
                offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
                    names=[id_col, "ids"])

    return df.select(id_col, text_col).mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Every column of ``df`` plus ``out_col``, the bytes that the ids stand for (null ids: null)."""
    spark = prepare(df.sparkSession)
    with open(ranks_path, "rb") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    kept = df.drop(out_col)
    names = [*kept.columns, out_col]
    at = names.index(ids_col)
    schema = T.StructType([*kept.schema.fields, T.StructField(out_col, T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = replay_of(vocabulary.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 250):
                part = batch.slice(lo, 250)
                ids = part.column(at)
                flat, size = replay.decode(ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
                ends = np.concatenate(([0], np.cumsum(size)))
                counts = np.nan_to_num(ids.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                offsets = ends[np.concatenate(([0], np.cumsum(counts)))].astype(np.int32)
                data = pa.Array.from_buffers(pa.binary(), part.num_rows,
                                             [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())])
                if ids.null_count:
                    data = pa.array([d if i.is_valid else None for i, d in zip(ids, data.to_pylist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, data], names=names)

    return kept.mapInArrow(run, schema)


def digest(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and SHA-256 of ids and decoded bytes."""
    return encoded.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
