"""Operator 7: language identification by words first, backing off to shorter and shorter character n-grams.

Training counts words and character n-grams (lengths 1 to ``MAX_N``, words marked at both ends) per language.  A known
word scores by its smoothed log frequency in each language.  An unseen word is scored by the mean log frequency of its
n-grams of the greatest length of which any is known: ``MAX_N``, else one less, and so on down to single characters.
A document's score per language is the log prior plus the sum over its words; the best language is predicted, its
posterior is the score.

The posterior saturates with the length of any text.  Whether a text is in a learned language at all is told by its
support: the share of it, by letters, that the predicted language knows, a word as a whole or by its n-grams of length
``SUPPORT_N``.  ``floors`` takes the least support of a language from the range of labelled texts held out of training.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metassoc.llm.common import lean
from metassoc.llm.wordcache import row_blocks
from metassoc.session import prepare

MAX_TRAIN_DOCS = 1000      # whole documents per language that the model is fitted on (expected; chosen by hash)
MIN_COUNT = 2              # words and n-grams seen less often are left to the back-off
MAX_N = 5
SMOOTHING = 0.5
SUPPORT_N = 4
LEAST_WORDS = 20           # texts with fewer words are too short for a floor on their support
LEAST_TEXTS = 20           # a language with fewer labelled held-out texts has the lowest floor of the others
FLOOR_SHARE = 0.7          # of the fifth percentile of labelled texts
SUPPORT_STEPS = 10_000     # supports are counted in steps of this fineness
UNDETERMINED = "und"
BLOCK_CHARS = 500_000
CACHE_WORDS = 150_000

words_of = re.compile(r"[^\W\d_]+").findall


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def grams_of(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies by language; index 0 of ``counts`` holds words, index n the n-grams of length n, each as
    {key: counts by language} or (keys, array of counts)."""

    def __init__(self, langs: list[str], docs: list[int], counts: list):
        self.langs = langs
        self.prior = np.log(np.array(docs, float) / max(1, sum(docs))) if langs else np.zeros(0)
        self.rows: list[dict[str, int]] = []
        self.logs: list[np.ndarray] = []
        self.seen: dict[int, np.ndarray] = {}
        for table in counts:
            keys, c = (list(table), np.array(list(table.values()))) if isinstance(table, dict) else table
            self.rows.append({k: i for i, k in enumerate(keys)})
            c = np.asarray(c, float).reshape(len(keys), len(langs))
            if len(self.logs) in (0, SUPPORT_N - 1, SUPPORT_N):
                self.seen[len(self.logs)] = c > 0
            self.logs.append(np.log((c + SMOOTHING) / (c.sum(axis=0) + SMOOTHING * (len(keys) + 1))))

    def score_word(self, word: str) -> np.ndarray:
        at = self.rows[0].get(word)
        if at is not None:
            return self.logs[0][at]
        for n in range(MAX_N, 0, -1):
            known = [i for g in grams_of(word, n) if (i := self.rows[n].get(g)) is not None]
            if known:
                return self.logs[n][known].mean(axis=0)
        return np.zeros(len(self.langs))

    def support_of(self, word: str) -> np.ndarray:
        """Share of a word known by language: 1 for a known word, else that of its n-grams (a letter alone is one of length 3)."""
        at = self.rows[0].get(word)
        whole = self.seen[0][at].astype(float) if at is not None else np.zeros(len(self.langs))
        n = SUPPORT_N if len(word) + 2 >= SUPPORT_N else SUPPORT_N - 1
        grams = grams_of(word, n)
        known = [i for g in grams if (i := self.rows[n].get(g)) is not None]
        return np.maximum(whole, self.seen[n][known].sum(axis=0) / len(grams))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_train_docs: int = MAX_TRAIN_DOCS) -> Model:
    """Model from the rows with text and language that are not held out: all of a language with ``max_train_docs``
    rows or fewer, else about that many, chosen by a hash of the id.  That bound also bounds what reaches the driver."""
    prepare(df.sparkSession)
    usable = df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()
                      & ~is_held_out(F.col(id_col))).select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    docs = {r.l: r.n for r in usable.groupBy("l").agg(F.count("*").alias("n")).collect()}
    langs = sorted(docs)
    if not langs:
        return Model([], [], [{} for _ in range(MAX_N + 1)])
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, max_train_docs / docs[k]))])
    drawn = F.pmod(F.xxhash64(F.col("i").cast("string"), F.lit("train")), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.where(drawn < share[F.col("l")]).select("l", "t")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.update((lang, w) for w in words_of(text.lower()))
            out: Counter = Counter()
            for (lang, w), k in seen.items():
                out[(0, lang, w)] += k
                for n in range(1, MAX_N + 1):
                    for g in grams_of(w, n):
                        out[(n, lang, g)] += k
            n, lang, key = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(lang, pa.string()), pa.array(key, pa.string()),
                                              pa.array(list(out.values()), pa.int64())], names=["n", "l", "k", "c"])

    by_lang = [F.sum(F.when(F.col("l") == k, F.col("c")).otherwise(0)).alias(f"c{i}") for i, k in enumerate(langs)]
    counted = (sample.mapInArrow(lean(count), "n int, l string, k string, c long").groupBy("n", "k").agg(F.sum("c").alias("total"), *by_lang)
               .where(F.col("total") >= MIN_COUNT).drop("total").sort("n", "k").toArrow())
    length = counted["n"].to_numpy()
    counts = []
    for n in range(MAX_N + 1):
        lo, hi = np.searchsorted(length, [n, n + 1])
        part = counted.slice(lo, hi - lo)
        counts.append((part["k"].to_pylist(), np.stack([part[f"c{i}"].to_numpy() for i in range(len(langs))], axis=1)))
    return Model(langs, [docs[k] for k in langs], counts)


class Scorer:
    """Scores of blocks of texts; word scores are kept, in arrays made once, and dropped when there are too many."""

    def __init__(self, model: Model, limit: int = CACHE_WORDS, with_support: bool = False):
        self.model, self.limit, self.with_support = model, limit, with_support
        self.support, self.n_words = np.zeros(0), np.zeros(0, int)          # of the last block, if asked for
        self.slot: dict[str, int] = {}
        self.scores = np.zeros((limit, len(model.langs)))
        self.supports = np.zeros((limit if with_support else 0, len(model.langs)))

    def _room(self, n: int) -> None:
        """A block of more different words than the limit makes the arrays larger."""
        if n > len(self.scores):
            more = n - len(self.scores)
            self.scores = np.concatenate((self.scores, np.zeros((more, self.scores.shape[1]))))
            if self.with_support:
                self.supports = np.concatenate((self.supports, np.zeros((more, self.scores.shape[1]))))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        model = self.model
        lower = [(t or "").lower() for t in texts]
        lettered = np.array([any(map(str.isalpha, t)) for t in lower], bool) if model.langs else np.zeros(len(texts), bool)
        docs = [words_of(t) for t in lower]
        del lower
        distinct = {w for words in docs for w in words}
        new = [w for w in distinct if w not in self.slot]
        if len(self.slot) + len(new) > self.limit:
            self.slot.clear()
            new = list(distinct)
        first = len(self.slot)
        self._room(first + len(new))
        for i, w in enumerate(new if model.langs else [], first):
            self.scores[i] = model.score_word(w)
            if self.with_support:
                self.supports[i] = model.support_of(w)
        self.slot.update(zip(new, range(first, first + len(new)), strict=True))
        self.support, self.n_words = np.zeros(len(texts)), np.array([len(words) for words in docs], int)
        lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        slot = self.slot
        for i in np.flatnonzero(lettered).tolist():
            total = model.prior + self.scores[[slot[w] for w in docs[i]]].sum(axis=0)
            best = int(total.argmax())
            lang[i], score[i] = model.langs[best], 1.0 / np.exp(np.minimum(total - total[best], 0.0)).sum()
            if self.with_support and docs[i]:
                self.support[i] = np.average(self.supports[[slot[w] for w in docs[i]], best], weights=[len(w) for w in docs[i]])
        return lang, score


def shared(df: DataFrame, model: Model) -> Broadcast:
    """The model broadcast once, for several predictions."""
    return prepare(df.sparkSession).sparkContext.broadcast(model)


def predict(df: DataFrame, model: Model | Broadcast, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
            with_support: bool = False) -> DataFrame:
    """(id_col, *keep, lang_pred, score) and, if asked for, (support, n_words) for every row: a learned language and its posterior, or ``und`` and 0 where the
    text is null, has no letter, or no language was learned.  Equal scores go to the first language by name.  Repeated
    rows and null ids are kept; columns not in ``keep`` are not read; an empty table gives no rows.

    The model is broadcast (see ``shared``); its size is bounded by ``MAX_TRAIN_DOCS`` (see ``fit``)."""
    sent = model if isinstance(model, Broadcast) else shared(df, model)
    names = [id_col, *[k for k in keep if k != id_col]]
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if with_support:
        added += [T.StructField("support", T.DoubleType()), T.StructField("n_words", T.LongType())]
    schema = T.StructType([*[df.schema[k] for k in names], *added])
    if {f.name for f in added} & set(names):
        raise ValueError(f"keep must not hold {', '.join(f.name for f in added)}")

    text_at = names.index(text_col) if text_col in names else len(names)        # a text that is kept is sent once

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value, with_support=with_support)
        for batch in batches:
            texts = batch.column(text_at)
            for lo, hi in row_blocks(texts, BLOCK_CHARS):
                lang, score = scorer.predict(texts.slice(lo, hi - lo).to_pylist())
                more = [pa.array(scorer.support), pa.array(scorer.n_words, pa.int64())] if with_support else []
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(lo, hi - lo) for i in range(len(names))],
                                                  pa.array(lang, pa.string()), pa.array(score), *more], names=schema.names)

    more = [F.col(text_col).alias("__text")] if text_at == len(names) else []
    return df.select(*[F.col(k) for k in names], *more).mapInArrow(lean(run), schema)


def floors(df: DataFrame, model: Model | Broadcast, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, float]:
    """Least support by language: ``FLOOR_SHARE`` of the fifth percentile of labelled texts, so that a few wrong labels do
    not move it.  From all held-out texts of ``LEAST_WORDS`` words or more; empty if no language has ``LEAST_TEXTS`` of them.

    The percentile is that of supports in steps of one ``SUPPORT_STEPS``-th, rounded down, so that what is counted is bounded
    by the steps and not by the texts."""
    prepare(df.sparkSession)
    langs = (model.value if isinstance(model, Broadcast) else model).langs
    usable = df.where(F.col(text_col).isNotNull() & F.col(lang_col).isin(langs) & is_held_out(F.col(id_col))).select(
        F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    found = predict(usable, model, "i", "t", keep=("l",), with_support=True)
    steps = found.where((F.col("l") == F.col("lang_pred")) & (F.col("n_words") >= LEAST_WORDS)).groupBy(
        "l", F.floor(F.col("support") * SUPPORT_STEPS).alias("s")).agg(F.count("*").alias("n"))
    ranges = steps.groupBy("l").agg(F.sum("n").alias("n"), F.percentile("s", 0.05, F.col("n")).alias("q"))
    own = {r.l: FLOOR_SHARE * r.q / SUPPORT_STEPS for r in ranges.collect() if r.n >= LEAST_TEXTS}
    return {k: own.get(k, min(own.values())) for k in langs} if own else {}
