"""Operator 6: secret scans through a trigram inverted index (DataFrame functions only).

From each rule's regex a Boolean query over trigrams is derived on the driver: parts of the regex that stand for a small set
of strings become a clause, "all trigrams of one of these strings"; every clause must hold for a text that matches.  The
index has a posting (trigram, text) for every trigram that some query asks for.  Postings are intersected per alternative,
alternatives united per clause, clauses intersected per rule; the texts left are candidates and are verified with the
regex.  Rules without a clause scan every text.  Equal texts are indexed and scanned once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metassoc.llm.common import staged
from metassoc.session import prepare

MAX_STRINGS = 64         # a part of a regex that stands for more strings than this ends a clause


@dataclass(frozen=True)
class Rule:
    """``pattern`` must mean the same in Python and Java and never match the empty string; a match counts if ``group`` has
    ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    ignore_case: bool = False
    base: bool = False

    @property
    def java(self) -> str:
        return ("(?i)" if self.ignore_case else "") + self.pattern


# A PEM key: the BEGIN line, header fields, the body and the END line.  Without an END line the body goes on to the text's
# end, or else to the last run of base64 that is too long for a word, and the token after it (the last line is short).
# Bodies may be quoted or escaped as in source text.  No loop crosses a dash, so a text is read once; the unbounded
# loops are over character classes, which Java matches without recursion.
_SPACE = r"\x20\t\r\n\f\x0b\x85" + "\u2028\u2029"        # the last two as characters: RE2 has no escape for them
_BASE64 = r"A-Za-z0-9+/="
_AROUND = _SPACE + r"""\\"'>#*|,"""
_FIELDS = rf"(?:[{_AROUND}]*[A-Za-z][A-Za-z0-9-]{{0,40}}:(?:-?-?[A-Za-z0-9,.:/+=;_()@\x20]){{0,200}}){{0,4}}"
PRIVATE_KEY = (rf"-----BEGIN [A-Z ]{{0,40}}PRIVATE KEY-----(?:{_FIELDS}(?:[^-]*-----END[A-Z\x20]{{0,60}}-{{0,5}}"
               rf"|[{_BASE64}{_AROUND}]*-{{0,5}}[A-Z\x20]{{0,60}}-{{0,5}}[{_SPACE}]*$"
               rf"|[{_BASE64}{_AROUND}]*[{_BASE64}]{{16}}[{_BASE64}]*(?:[{_AROUND}]+[{_BASE64}]+)?))?")

RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, base=True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, base=True),      # the maximal runs of hex digits that are long enough
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", PRIVATE_KEY),
)


def _strings(items) -> list[set[str] | None]:
    """Parts of a parsed regex in order: the set of strings a part stands for, or None for "anything"."""
    parts: list[set[str] | None] = []
    for op, arg in items:
        if op is sre.LITERAL:
            parts.append({chr(arg)})
        elif op is sre.IN and all(o in (sre.LITERAL, sre.RANGE) for o, _ in arg):
            chars = {chr(c) for o, a in arg for c in ([a] if o is sre.LITERAL else range(a[0], a[1] + 1))}
            parts.append(chars if len(chars) <= MAX_STRINGS // 8 else None)
        elif op is sre.BRANCH:
            whole = [_joined(_strings(branch)) for branch in arg[1]]
            parts.append(set().union(*[w[0] for w in whole]) if all(len(w) == 1 and w[0] for w in whole) else None)
        elif op is sre.SUBPATTERN:
            parts += _strings(arg[-1])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, inner = arg
            once = _joined(_strings(inner))
            if len(once) == 1 and once[0] and most == 1:
                parts.append(once[0] | {""} if least == 0 else once[0])
            else:
                parts += [p for _ in range(min(least, 4)) for p in _strings(inner)] + [None]
        elif op is not sre.AT:
            parts.append(None)
    return parts


def _joined(parts: list[set[str] | None]) -> list[set[str] | None]:
    """Neighbouring string sets multiplied out as far as ``MAX_STRINGS`` allows."""
    out: list[set[str] | None] = []
    for p in parts:
        if p and out and out[-1] and len(out[-1]) * len(p) <= MAX_STRINGS:
            out[-1] = {a + b for a in out[-1] for b in p}
        else:
            out.append(p)
    return out


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Clauses that a matching text fulfils in lower case: all trigrams of one of a clause's alternatives occur in it."""
    clauses = []
    for strings in _joined(_strings(_parser.parse(pattern))):
        if strings and min(map(len, strings)) >= 3:
            alternatives = {frozenset(s.lower()[i:i + 3] for i in range(len(s) - 2)) for s in strings}
            clauses.append(sorted((a for a in alternatives if not any(b < a for b in alternatives)), key=sorted))
    return clauses


def build_index(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Postings (trigram, key) of (key, text), for the trigrams that the rules' queries ask for; written as a table."""
    asked = sorted({t for r in rules for clause in trigram_query(r.pattern) for a in clause for t in a})
    low = texts.select("key", F.lower("text").alias("low"))
    held = F.filter(F.lit(asked), lambda t: F.contains(F.col("low"), t)) if asked else F.array().cast("array<string>")
    return staged(low.select(F.explode(held).alias("trigram"), "key").distinct(), "postings")


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, rules array<int>): numbers of the indexed rules whose query a text fulfils."""
    entries = [(t, r, c, a, len(alt)) for r, rule in enumerate(rules) for c, clause in enumerate(trigram_query(rule.pattern))
               for a, alt in enumerate(clause) for t in sorted(alt)]
    need = {r: len(trigram_query(rule.pattern)) for r, rule in enumerate(rules)}
    if not entries:
        return postings.select("key", F.array().cast("array<int>").alias("rules")).limit(0)
    uses = F.create_map(*[F.lit(x) if isinstance(x, str) else x for t in sorted({e[0] for e in entries}) for x in (
        t, F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("r", "c", "a", "size"), e[1:], strict=True)]) for e in entries if e[0] == t]))])
    each = postings.select("key", F.explode(uses[F.col("trigram")]).alias("u")).select("key", "u.*")
    met = each.groupBy("key", "r", "c", "a").agg(F.count("*").alias("n"), F.min("size").alias("size")).where("n = size")
    clauses = met.groupBy("key", "r").agg(F.countDistinct("c").alias("n"))
    wanted = F.create_map(*[F.lit(x) for r, n in need.items() for x in (r, n)])
    return clauses.where(F.col("n") == wanted[F.col("r")]).groupBy("key").agg(F.collect_set("r").alias("rules"))


def _matches(text: Column, rule: Rule) -> Column:
    """array<struct<gap, n, ok>>: characters since the last match, characters of the match, whether it counts."""
    found = F.regexp_extract_all(text, F.lit(rule.java), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.java), F.lit(rule.group))
    gaps = F.split(text, rule.java, -1)
    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("g"), found.alias("f"), tested.alias("t"))
    return F.transform(zipped, lambda z: F.struct(F.char_length(z["g"]).alias("gap"), F.char_length(z["f"]).alias("n"),
                                                  (F.char_length(z["t"]) >= rule.least).alias("ok")))


def _key(text: Column) -> Column:
    return F.when(text != "", F.unhex(F.md5(text.cast("binary"))))


def spans_by_text(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, spans) of the different texts of (id, text) that have spans; see ``scan``."""
    texts = docs.where(F.col("text") != "").withColumn("key", _key(F.col("text")))
    texts = texts.withColumn("uid", F.coalesce(F.col("id").cast("string"), F.hex("key")))
    found = candidates(build_index(texts, rules), rules)
    # one row for each different text, chosen by id: ids do not repeat as texts do, so the join with the texts is even
    reps = staged(texts.groupBy("key").agg(F.min("uid").alias("uid")).join(found, "key", "left"), "candidates")
    one = texts.select("key", "uid", "text").join(reps, ["key", "uid"])
    full = [r for r, rule in enumerate(rules) if not trigram_query(rule.pattern)]
    per_rule = [F.when(F.lit(True) if r in full else F.array_contains("rules", r), _matches(F.col("text"), rule)) for r, rule in enumerate(rules)]
    hits = one.select("key", *[c.alias(f"m{r}") for r, c in enumerate(per_rule)])
    hits = hits.where(reduce(Column.__or__, [F.size(f"m{r}") > 0 for r in range(len(rules))]))
    hits = staged(hits.dropDuplicates(["key"]), "matches")
    each = reduce(DataFrame.union, [hits.where(F.size(f"m{r}") > 0).select("key", F.lit(r).alias("rule"), F.posexplode(f"m{r}").alias("pos", "m"))
                                    for r in range(len(rules))])
    so_far = Window.partitionBy("key", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum((F.col("m.gap") + F.col("m.n")).cast("long")).over(so_far)
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    placed = each.withColumn("end", end).where("m.ok").select("key", F.struct(
        (F.col("end") - F.col("m.n")).alias("start"), "rule", "end", F.element_at(kinds, F.col("rule") + 1).alias("kind")).alias("s"))
    return placed.groupBy("key").agg(F.sort_array(F.collect_list("s")).alias("spans"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id_col, spans array<struct<start, rule, end, kind>>) for every row: the matches of every rule that count, leftmost and
    not overlapping within a rule, in code points of the whole text, end exclusive; by start, then rule.

    A null or empty text has no spans; repeated rows and null ids are kept; other columns are not read; an empty table
    gives no rows."""
    prepare(df.sparkSession)
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spans = spans_by_text(docs, rules)
    none = F.array().cast(spans.schema["spans"].dataType)
    found = docs.select("id", _key(F.col("text")).alias("key")).join(spans, "key", "left")
    return found.select(F.col("id").alias(id_col), F.coalesce("spans", none).alias("spans"))


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[REDACTED]") -> DataFrame:
    """``df`` with every span of ``scan`` (overlapping ones together) replaced by ``mark`` in ``text_col``; all rows stay."""
    prepare(df.sparkSession)
    spans = spans_by_text(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), rules).select(
        F.col("key").alias("__key"), F.transform("spans", lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"))).alias("__spans"))
    text = F.col(text_col)
    piece = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    cut = F.aggregate("__spans", start, lambda acc, s: F.struct(
        F.greatest(acc["at"], s["b"]).alias("at"),
        F.when(s["a"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.array(piece(acc["at"], s["a"]), F.lit(mark)))).alias("out")),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2147483647))))
    joined = df.withColumn("__own", _key(text)).join(spans, F.col("__own") == F.col("__key"), "left")
    columns = [F.when(F.col("__spans").isNotNull(), cut).otherwise(text).alias(c) if c == text_col else F.col(c) for c in df.columns]
    return joined.select(*columns)


def digest(found: DataFrame, id_col: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts per base rule, the hash of the base spans, and all spans as text."""
    def said(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    def count(r):
        return F.size(F.filter("spans", lambda s: s["rule"] == r)).cast("long").alias(f"n_{rules[r].kind}")
    base = [r for r, rule in enumerate(rules) if rule.base]
    counts = [count(r) for r in base]
    of_base = F.filter("spans", lambda s: s["rule"].isin(base))
    return found.select(id_col, *counts, F.sha2(said(of_base).cast("binary"), 256).alias("base_sha256"), said("spans").alias("spans"))
