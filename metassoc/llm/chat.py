"""Operator 2: chat formatting checked by a grammar round trip (DataFrame functions only).

Grammar of the rendered text, for a ``Template``:

    conversation = { open role head text close }

No control string occurs inside a rendered role or text.  The parser is deterministic: cut at every ``close``,
take ``open`` off each piece, cut it at the first ``head``, refuse roles and texts that hold a control string, and
unescape both.

A turn is first rendered as it is and parsed again.  If the parser does not give back its role and text, both are
escaped: one backslash goes after the first character of every control string, and of every control string that
already has backslashes there, so that unescaping (one backslash less) is the exact inverse.  In the end every whole
conversation is parsed again and compared with its source; a difference is an error, never a wrong row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``open``, ``head`` and ``close`` must hold a control string each; ``loss_role``: whose texts are trained on."""

    open: str = "<s>[INST] "
    head: str = " [/INST]"
    close: str = "</s>"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    loss_role: str = "assistant"

    def __post_init__(self) -> None:
        if any(len(c) < 2 or "\\" in c for c in self.controls) or self.close not in self.controls:
            raise ValueError("controls need two characters or more, no backslash, and must hold close")
        for c in self.controls:          # else putting a backslash into one would undo another
            if re.search(self.pattern(""), c[1:]):
                raise ValueError(f"a control string starts inside {c!r}")

    def pattern(self, backslashes: str) -> str:
        """First character (group 1) and backslashes (group 2), followed by the rest of a control string."""
        def quote(s):
            return "".join(ch if ch.isalnum() else "\\" + ch for ch in s)
        first = "".join(sorted({quote(c[0]) for c in self.controls}))
        return f"([{first}])({backslashes})(?={'|'.join(sorted({quote(c[1:]) for c in self.controls}))})"

    def escape(self, c: Column) -> Column:
        return F.regexp_replace(c, self.pattern(r"\\*"), r"$1\\$2")

    def unescape(self, c: Column) -> Column:
        return F.regexp_replace(c, self.pattern(r"\\+").replace(r"(\\+)", r"\\(\\*)"), "$1$2")

    def allowed(self, c: Column) -> Column:
        return ~F.rlike(c, F.lit(self.pattern("")))

    def render(self, role: Column, text: Column) -> Column:
        return F.concat(F.lit(self.open), role, F.lit(self.head), text, F.lit(self.close))

    def parse(self, formatted: Column) -> Column:
        """array<struct<role, text>>; an entry with nulls where the grammar doesn't hold."""
        pieces = F.split(formatted, re.escape(self.close), -1)
        return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), self._parse_turn)

    def _parse_turn(self, piece: Column) -> Column:
        n_open, n_head = len(self.open), len(self.head)
        rest = F.substring(piece, n_open + 1, 2147483647)
        at = F.instr(rest, F.lit(self.head))
        role = F.substring(rest, F.lit(1), at - 1)
        text = F.substring(rest, at + n_head, F.lit(2147483647))
        ok = F.startswith(piece, F.lit(self.open)) & (at > 0) & self.allowed(role) & self.allowed(text)
        return F.struct(F.when(ok, self.unescape(role)).alias("role"), F.when(ok, self.unescape(text)).alias("text"))


def format_conversations(turns: DataFrame, template: Template = Template(), conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: (conv, formatted, loss_spans).

    ``loss_spans``: array<struct<start, end>> in code points of ``formatted``, end exclusive, one for each text of the
    loss role.  Turns come in the order of turn, role, text (repeated rows stay; a null turn comes first); a null
    role or text counts as empty; null conversation ids form one conversation; other columns are not read; an empty
    table gives no rows.  A conversation is one value, so its turns meet in one task."""
    t = template
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    raw = t.render(F.col("role"), F.col("text"))
    same = F.array(F.struct("role", "text"))
    rows = rows.withColumn("plain", F.coalesce(t.parse(raw) == same, F.lit(False)))
    rows = rows.withColumn("r", F.when(F.col("plain"), F.col("role")).otherwise(t.escape(F.col("role"))))
    rows = rows.withColumn("x", F.when(F.col("plain"), F.col("text")).otherwise(t.escape(F.col("text"))))
    rows = rows.withColumn("n", F.char_length("x").cast("long") + F.char_length("r") + len(t.open + t.head + t.close))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = rows.withColumn("at", F.row_number().over(order)).withColumn(
        "start", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.char_length("x") - len(t.close))
    whole = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(
        "at", "role", "text", t.render(F.col("r"), F.col("x")).alias("rendered"), "start",
        (F.col("start") + F.char_length("x")).alias("end")))).alias("t"))
    whole = whole.select(
        "conv", F.array_join(F.col("t.rendered"), "").alias("formatted"),
        F.transform("t", lambda e: F.struct(e["role"].alias("role"), e["text"].alias("text"))).alias("source"),
        F.transform(F.filter("t", lambda e: e["role"] == t.loss_role),
                    lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"))).alias("loss_spans"))
    checked = F.when(F.coalesce(t.parse(F.col("formatted")) == F.col("source"), F.lit(False)), F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("conversation changed by its round trip: "), F.coalesce(F.col("conv").cast("string"), F.lit("null")))))
    return whole.select(F.col("conv").alias(conv), checked.alias("formatted"), "loss_spans")


def digest(formatted: DataFrame, template: Template = Template(), conv: str = "conv_id") -> DataFrame:
    """Counts and hashes, all read back from the formatted text."""
    turns = template.parse(F.col("formatted"))
    lost = F.array_join(F.transform("loss_spans", lambda s: template.unescape(F.substring(
        F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    read = formatted.select(conv, "formatted", turns.alias("turns"), lost.alias("lost"))
    said = F.array_join(F.transform("turns", lambda e: F.concat(e["role"], F.lit("\n"), e["text"], F.lit("\n"))), "")
    return read.select(
        conv, F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("lost").cast("long").alias("loss_chars"), F.sha2(F.col("lost").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
