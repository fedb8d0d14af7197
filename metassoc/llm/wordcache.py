"""Encoding of texts word by word, with a bounded cache of the words already encoded (helper of the tokenizers)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs flat[start : start + size], one after another."""
    before = np.cumsum(size) - size
    return flat[np.repeat(start - before, size) + np.arange(int(size.sum()))]


def blocks(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` characters, or of one row."""
    first, chars = 0, 0
    for i, t in enumerate(texts):
        if chars and chars + len(t) > limit:
            yield first, i
            first, chars = i, 0
        chars += len(t)
    if first < len(texts):
        yield first, len(texts)


def row_blocks(texts, limit: int) -> Iterator[tuple[int, int]]:
    """``blocks`` of an Arrow column of strings, without making Python strings of it."""
    import pyarrow.compute as pc
    length = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate(([0], np.cumsum(length, dtype=np.int64)))
    first = 0
    while first < len(length):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, "right")) - 1)
        yield first, last
        first = last


class WordCache:
    """Ids of the words seen so far; new words of a block are encoded together.  When there are more than ``limit``, those
    used least are dropped.

    ``encode_words``: list of words -> (all ids, ids per word)."""

    def __init__(self, encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int):
        self.encode_words, self.limit = encode_words, limit
        self.slot: dict[str, int] = {}
        self.flat, self.start, self.size, self.uses = np.zeros(0, np.int32), *(np.zeros(0, np.int64) for _ in range(3))

    def _shrink(self) -> None:
        """Keep at most half the limit, the words used most; older uses count half as much each time."""
        least = max(2, int(np.sort(self.uses)[::-1][min(self.limit // 2, len(self.uses) - 1)]) + 1)
        kept = self.uses >= least
        names = [w for w, k in zip(self.slot, kept.tolist(), strict=True) if k]
        self.slot = dict(zip(names, range(len(names)), strict=True))
        self.flat = gather(self.flat, self.start[kept], self.size[kept])
        self.size, self.uses = self.size[kept], self.uses[kept] // 2
        self.start = np.cumsum(self.size) - self.size

    def _add(self, new: list[str]) -> None:
        ids, size = self.encode_words(new)
        first = len(self.slot)
        self.slot.update(zip(new, range(first, first + len(new)), strict=True))
        self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(size) - size))
        self.size = np.concatenate((self.size, size))
        self.uses = np.concatenate((self.uses, np.zeros(len(new), np.int64)))
        self.flat = np.concatenate((self.flat, ids.astype(np.int32)))

    def encode(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per document)"""
        if len(self.slot) > self.limit:
            self._shrink()
        flat = list(chain.from_iterable(docs))
        index = np.fromiter(map(self.slot.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(index < 0)
        if len(missing):
            words = [flat[i] for i in missing.tolist()]
            self._add(list(dict.fromkeys(words)))
            index[missing] = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))
        self.uses += np.bincount(index, minlength=len(self.uses))
        size = self.size[index]
        ends = np.cumsum([len(words) for words in docs])
        total = np.concatenate(([0], np.cumsum(size)))[ends]
        return gather(self.flat, self.start[index], size), np.diff(total, prepend=0)


class ArrowWordCache:
    """As ``WordCache``, for texts in Arrow: words are cut at spaces (each with the space behind it) and looked up as one
    column, so that only new words become Python strings.

    ``encode_words``: list of words -> (all ids, ids per word)."""

    def __init__(self, encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int):
        import pyarrow as pa
        self.encode_words, self.limit = encode_words, limit
        self.words = pa.array([], pa.string())
        self.flat, self.start, self.size, self.uses = np.zeros(0, np.int32), *(np.zeros(0, np.int64) for _ in range(3))

    @staticmethod
    def cut(texts):
        """(words of all texts, words per text)"""
        import pyarrow as pa
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        at = offsets - offsets[0]
        ends = np.zeros(len(data) + 1, bool)
        ends[1:] = data == 32
        ends[at] = True
        ends[0] = False
        ends = np.flatnonzero(ends).astype(np.int32)
        words = pa.StringArray.from_buffers(len(ends), pa.py_buffer(np.concatenate((np.zeros(1, np.int32), ends))), pa.py_buffer(data))
        return words, np.diff(np.searchsorted(ends, at, "right"))

    def _shrink(self) -> None:
        import pyarrow as pa
        least = max(2, int(np.sort(self.uses)[::-1][min(self.limit // 2, len(self.uses) - 1)]) + 1)
        kept = self.uses >= least
        self.words = self.words.filter(pa.array(kept))
        self.flat = gather(self.flat, self.start[kept], self.size[kept])
        self.size, self.uses = self.size[kept], self.uses[kept] // 2
        self.start = np.cumsum(self.size) - self.size

    def _add(self, new) -> None:
        import pyarrow as pa
        ids, size = self.encode_words([w.removesuffix(" ") for w in new.to_pylist()])
        self.words = pa.concat_arrays([self.words, new])
        self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(size) - size))
        self.size, self.uses = np.concatenate((self.size, size)), np.concatenate((self.uses, np.zeros(len(size), np.int64)))
        self.flat = np.concatenate((self.flat, ids.astype(np.int32)))

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text)"""
        import pyarrow as pa
        import pyarrow.compute as pc
        if len(self.words) > self.limit:
            self._shrink()
        words, per_text = self.cut(texts)
        index = pc.fill_null(pc.index_in(words, self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        missing = np.flatnonzero(index < 0)
        if len(missing):
            new = words.take(pa.array(missing)).dictionary_encode()
            index[missing] = len(self.words) + new.indices.to_numpy()
            self._add(new.dictionary)
        self.uses += np.bincount(index, minlength=len(self.uses))
        size = self.size[index]
        total = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(per_text)))]
        return gather(self.flat, self.start[index], size), np.diff(total)


_CACHES: dict[tuple, WordCache | ArrowWordCache] = {}


def worker_cache(name: tuple, make: Callable[[], Callable[[list[str]], tuple[np.ndarray, np.ndarray]]], limit: int, kind=WordCache):
    """The cache of this Python worker for the encoder ``name``; it lives on from task to task, one at a time."""
    if name not in _CACHES:
        _CACHES.clear()
        _CACHES[name] = kind(make(), limit)
    return _CACHES[name]
