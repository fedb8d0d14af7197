"""Operator 4: packing by concatenate and cut.

Pass 1 tokenizes every partition and writes the ids with each document's offset inside its partition.  The partition
totals (one row per partition) are summed up to global offsets.  Pass 2 cuts the endless id stream into windows of a
fixed length: a document's piece in a window is a boundary record (document, start, length, sequence, offset).
No row is exchanged between tasks; only the last window is padded.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metassoc.llm.common import lean, staged
from metassoc.llm.wordcache import ArrowWordCache, row_blocks, worker_cache
from metassoc.session import prepare

LENGTH = 2048
BLOCK_CHARS = 1_000_000
CACHE_WORDS = 250_000
CACHE_PIECES = 100_000

# capital dotted I, and everything from the combining marks on
BEYOND_LATIN = "[\u0130\u0300-\U0010ffff]"

# printable ASCII but capitals, and letters below the combining marks
LETTERS = "a-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02c1"
plain_word = re.compile(f"[!-@\\[-~{LETTERS}]+").fullmatch
# fixed value: the tokenizer's own pattern for such characters
pieces_of = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[!-/:-@\[-`{{-~]+").findall


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it is visible, else the next one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def word_encoder(model_json: str, cache_pieces: int = CACHE_PIECES):
    """list of words -> (ids, ids per word) as the ``tokenizers`` library encodes them.

    A word of printable ASCII and Latin letters is cut into the tokenizer's pieces, each encoded once by the library's merge model;
    any other word goes through the whole tokenizer."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(model_json)
    merge, letters = tokenizer.model.tokenize, byte_letters()
    known: dict[str, list[int]] = {}

    def piece(p: str) -> list[int]:
        ids = known.get(p)
        if ids is None:
            ids = known[p] = [t.id for t in merge(p if p.isascii() else p.encode().decode("latin-1").translate(letters))]
        return ids

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(known) > cache_pieces:
            known.clear()
        out, sizes = [], []
        for w in words:
            if not w:
                ids = []
            elif w.isalpha() and w.isascii() and w.islower():
                ids = piece(w)
            elif plain_word(w) and (w.isascii() or w == w.lower()):
                ids = [i for p in pieces_of(w) for i in piece(p)]
            else:
                ids = tokenizer.encode(w, add_special_tokens=False).ids
            out += ids
            sizes.append(len(ids))
        return np.array(out, np.int64), np.array(sizes, np.int64)

    return encode


def folded(texts: pa.Array) -> pa.Array:
    """Line feeds as spaces; in lower case where that is one letter for one letter and leaves nothing to compose, as the
    tokenizer folds case itself: fewer different words then."""
    texts = pc.replace_substring(texts, "\n", " ")
    return pc.if_else(pc.match_substring_regex(texts, BEYOND_LATIN), texts, pc.utf8_lower(texts))


def tokenize(df: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
             block_chars: int = BLOCK_CHARS, cache_words: int = CACHE_WORDS) -> DataFrame:
    """(id_col, ids array<int>, part int, part_start long), written to the shared folder: the ids of every whole text
    plus ``end_id``, and where they start in the id stream of their partition.

    Texts are cut at spaces and line feeds, which the word tokenizer drops, and each distinct word is encoded once per
    worker.  A text that holds one of the tokenizer's added tokens goes through the library whole, which gives that token its
    own id.  Null or empty texts have the end id alone; repeated rows and null ids are kept; other columns are not
    read; an empty table gives no rows."""
    spark = prepare(df.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        model_json = f.read()
    added = tuple(t["content"] for t in json.loads(model_json).get("added_tokens", []))
    model = spark.sparkContext.broadcast(model_json)
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
                           T.StructField("part", T.IntegerType()), T.StructField("part_start", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        cache = worker_cache(("word", hash(model.value), cache_words), lambda: word_encoder(model.value), cache_words, ArrowWordCache)
        library = None
        for batch in batches:
            for lo, hi in row_blocks(batch.column(1), block_chars):
                texts = batch.column(1).slice(lo, hi - lo).fill_null("")
                held = np.zeros(hi - lo, bool)
                for a in added:
                    held |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
                whole = np.flatnonzero(held).tolist()
                flat, size = cache.encode(folded(pc.if_else(pa.array(held), "", texts) if whole else texts))
                if whole:
                    from tokenizers import Tokenizer
                    library = library or Tokenizer.from_str(model.value)
                    rows = np.split(flat, np.cumsum(size)[:-1])
                    for i in whole:
                        rows[i] = np.array(library.encode(texts[i].as_py(), add_special_tokens=False).ids, np.int64)
                    flat, size = np.concatenate(rows), np.array([len(r) for r in rows], np.int64)
                flat = np.insert(flat, np.cumsum(size), end_id).astype(np.int32)
                size = size + 1
                ends = np.cumsum(size)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo),
                    pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(flat)),
                    pa.array(np.full(hi - lo, part, np.int32)), pa.array(total + ends - size)],
                    names=[id_col, "ids", "part", "part_start"])
                total += int(ends[-1])

    return staged(df.select(id_col, text_col).mapInArrow(lean(run), schema), "tokens")


def pack(tokens: DataFrame, length: int = LENGTH, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Pieces of the documents of ``tokens`` (see ``tokenize``) in windows of ``length`` ids:
    (id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])."""
    totals = tokens.groupBy("part").agg(F.sum(F.size("ids").cast("long")).alias("n"))
    # one row per partition of the token table: as many rows as tasks, which is what bounds window and broadcast
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = totals.select("part", (F.sum("n").over(before) - F.col("n")).alias("part_offset"))
    placed = tokens.join(F.broadcast(offsets), "part").select(id_col, (F.col("part_offset") + F.col("part_start")).alias("g"), "ids")
    long = lambda name: T.StructField(name, T.LongType())
    schema = T.StructType([T.StructField(id_col, tokens.schema[id_col].dataType), long("start"), long("length"), long("ids_crc32"),
                           long("doc_tokens"), long("sequence_id"), long("offset"),
                           *[T.StructField("ids", T.ArrayType(T.IntegerType(), False))] * with_ids])
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                yield cut(batch.slice(lo, 1000), length, names)

    return placed.mapInArrow(lean(run), schema)


def cut(batch: pa.RecordBatch, length: int, names: list[str]) -> pa.RecordBatch:
    """The pieces of a batch (id, g, ids), g being where the document's ids start in the global stream."""
    g = batch.column(1).to_numpy().astype(np.int64)
    ids = batch.column(2)
    flat, n = ids.flatten().to_numpy().astype("<u4"), ids.value_lengths().to_numpy().astype(np.int64)
    first = np.cumsum(n) - n
    pieces = (g + n - 1) // length - g // length + 1
    row = np.repeat(np.arange(len(n)), pieces)
    sequence = g[row] // length + np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    lo, hi = np.maximum(g[row], sequence * length), np.minimum(g[row] + n[row], (sequence + 1) * length)
    start = lo - g[row]
    a, raw = first[row] + start, memoryview(flat.tobytes())
    crc = np.fromiter((zlib.crc32(raw[4 * x:4 * (x + k)]) for x, k in zip(a.tolist(), (hi - lo).tolist(), strict=True)), np.int64, len(row))
    columns = [batch.column(0).take(pa.array(row)), *map(pa.array, (start, hi - lo, crc, n[row], sequence, lo - sequence * length))]
    if "ids" in names:     # the pieces of a batch follow one another, so their ids do, too
        columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(hi - lo))).astype(np.int32)), pa.array(flat.astype(np.int32))))
    return pa.RecordBatch.from_arrays(columns, names=names)


def sequences(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """(sequence_id, n_pieces, n_tokens, padded_length) of the packed windows."""
    return pieces.groupBy("sequence_id").agg(F.count("*").alias("n_pieces"), F.sum("length").alias("n_tokens"),
                                             F.lit(length).cast("long").alias("padded_length"))
