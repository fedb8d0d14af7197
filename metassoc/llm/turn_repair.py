"""Operator 13: conversation structure repair by cost dynamic programming and prefix-doubling path ranking.

A sound conversation has the role initials ``(s?(ua)+)?``.  Each row is kept (0), gets another role (2) or is deleted (3, and must
be if it is blank or a duplicate); rows without text are inserted anywhere (2); a truncated row that is not deleted adds 1.
The audit of a repair is the initials of its edits in order, K R D I.

States of the grammar: 0 nothing yet, 1 after s, 2 after u, 3 after a.  A node is (rows consumed, state).

* Costs: from the last row back, the least cost from every node to a sound end, for all conversations of a block at once.
* Ranking: the arcs on cheapest paths are ranked by the least audit that starts with them, first by one letter, then by
  2, 4, 8 ... letters: an arc's rank of twice the length is that of the pair (own rank, least rank where its pointer ends), and
  its pointer is doubled through the arc chosen there.
* The least path is read off by composing the doubled pointers, every place of every audit at once.

The rows of a conversation are put in order by a global sort over ranges, and their faults found by aggregates that are
combined before they are exchanged, so that one conversation may hold a third of all rows.  What meets in one task is one
byte for each row of a conversation (its audit is of that length), ranked in spans of ``SPAN`` rows; texts are not collected:
the repaired conversation is read as a sorted stream by whoever hashes or writes it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metassoc.llm.common import staged
from metassoc.session import prepare

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2       # costs
BIG = 1 << 40
SPAN = 4096               # rows ranked together
BLOCK_ROWS = 100_000      # of several conversations, or one conversation
INITIALS = "sua"          # a fourth class holds every other role
FAULTS = ("none", "blank", "duplicate", "truncated")
# fixed tables of the grammar
AFTER = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])       # [state, role class]
STEP = np.array([2, 2, 3, 2])                    # state after the only role that may be inserted or given in a state
GIVEN = "uuau"                                   # and that role


# --- cost and ranking of blocks of conversations ----------------------------------------------------------------------------

def _arcs_of(codes: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, ...]:
    """(cost, state) of the delete, keep and rerole arcs of rows with ``codes`` in every state, given the costs behind the rows."""
    role, fault = codes // 4, codes % 4
    must_go = ((fault == 1) | (fault == 2))[:, None]
    cut = (fault == 3).astype(np.int64)[:, None]
    to = AFTER[:, role].T
    delete = DELETE + after
    keep = np.where(must_go | (to < 0), BIG, KEEP + cut + np.take_along_axis(after, np.maximum(to, 0), 1))
    rerole = np.where(must_go, BIG, REROLE + cut + after[:, STEP])
    return delete, keep, rerole, to


def _with_inserts(best: np.ndarray) -> np.ndarray:
    """Least costs where rows may be inserted first; two in a row at most pay."""
    u, a = np.minimum(best[:, 2], INSERT + best[:, 3]), np.minimum(best[:, 3], INSERT + best[:, 2])
    return np.stack([np.minimum(best[:, 0], INSERT + u), np.minimum(best[:, 1], INSERT + u), u, a], axis=1)


END = _with_inserts(np.array([[0, BIG, BIG, 0]]))[0]


def costs(codes: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(nodes, 4): least cost to the end from before each row, and after the last one, of conversations with ``size`` rows
    from ``first`` on; conversation c has its nodes from first[c] + c on."""
    out = np.empty((len(codes) + len(first), 4), np.int64)
    base = first + np.arange(len(first))
    out[base + size] = END
    order = np.argsort(-size, kind="stable")
    base, left, first = base[order], size[order], first[order]
    for back in range(1, int(size.max(initial=0)) + 1):
        m = int(np.searchsorted(-left, -back, "right"))          # conversations with as many rows
        at = left[:m] - back
        delete, keep, rerole, _ = _arcs_of(codes[first[:m] + at], out[base[:m] + at + 1])
        out[base[:m] + at] = _with_inserts(np.minimum(np.minimum(delete, keep), rerole))
    return out


def _ranked_paths(codes: np.ndarray, size: np.ndarray, dist: np.ndarray, start: np.ndarray, last: np.ndarray) -> list[tuple[str, int]]:
    """(edits, state at the end) of the least cheapest path through each span, from state ``start``.

    ``dist``: costs of the spans' nodes, one more than rows in each; ``last``: the span ends its conversation, so that its
    last node may insert and must end soundly.  Edits: K, D, U or A (new role), and u or a for an insert."""
    spans, nodes = len(size), len(dist)
    base = np.cumsum(size + 1) - (size + 1)
    ends = base + size
    is_end = np.zeros(nodes, bool)
    is_end[ends] = True
    rows = np.flatnonzero(~is_end)
    delete, keep, rerole, to = _arcs_of(codes, dist[rows + 1])
    state = np.arange(4)[None, :]
    tail, head, letter = [], [], []

    def add(mask: np.ndarray, at: np.ndarray, target: np.ndarray, name: int) -> None:
        r, q = np.nonzero(mask)
        tail.append(at[r] * 4 + q)
        head.append(np.broadcast_to(target, mask.shape)[r, q])
        letter.append(np.full(len(r), name))

    here = dist[rows]
    add(delete == here, rows, (rows[:, None] + 1) * 4 + state, 0)                      # letters in ASCII order: D I K R
    add(keep == here, rows, (rows[:, None] + 1) * 4 + np.maximum(to, 0), 2)
    add(rerole == here, rows, (rows[:, None] + 1) * 4 + STEP[None, :], 3)
    open_end = np.zeros(nodes, bool)
    open_end[ends[last]] = True
    grow = np.flatnonzero(~is_end | open_end)
    may = INSERT + dist[grow][:, STEP] == dist[grow]
    may &= ~(open_end[grow][:, None] & np.isin(state, (0, 3)))                         # a sound end is the end
    add(may, grow, grow[:, None] * 4 + STEP[None, :], 1)
    tail, head, letter = map(np.concatenate, (tail, head, letter))
    order = np.argsort(tail, kind="stable")
    tail, head, letter = tail[order], head[order], letter[order]
    arcs, total = len(tail), nodes * 4
    first_arc = np.searchsorted(tail, np.arange(total + 1))                             # arcs of a node lie together
    has = first_arc[1:] > first_arc[:-1]

    def least(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least rank, its arc) of every node; a node without arcs ranks before all and has no arc."""
        low, arc = np.full(total, -1), np.full(total, -1)
        if arcs:
            key = rank * arcs + np.arange(arcs)
            found = np.minimum.reduceat(key, first_arc[:-1][has])
            low[has], arc[has] = found // arcs, found % arcs
        return low, arc

    rank, pointer, jumps = letter.copy(), head.copy(), []
    while True:
        low, arc = least(rank)
        goes = np.where(arc >= 0, pointer[arc] if arcs else 0, np.arange(total))       # 2**k letters on by the least audit
        jumps.append(goes)
        if not has[goes].any():
            break
        pair = rank * (low.max() + 2) + low[pointer] + 1
        rank, pointer = np.unique(pair, return_inverse=True)[1], goes[pointer]
    _, chosen = least(rank)

    # place p of a path: the jumps of the bits of p, from the start
    root = base * 4 + start
    lengths, at = np.zeros(spans, np.int64), root.copy()
    for k in range(len(jumps) - 1, -1, -1):
        far = jumps[k][at]
        short = has[far]
        lengths += np.where(short, 1 << k, 0)
        at = np.where(short, far, at)
    lengths += has[at]
    owner = np.repeat(np.arange(spans), lengths)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = root[owner]
    for k, jump in enumerate(jumps):
        at = np.where(place >> k & 1 == 1, jump[at], at)
    if len(at):
        taken = letter[chosen[at]]
        given = np.array(list(GIVEN))[at % 4]
        named = np.where(taken == 0, "D", np.where(taken == 2, "K", np.where(taken == 1, given, np.char.upper(given))))
        text, stop = "".join(named.tolist()), np.cumsum(lengths)
        final = head[chosen[at[np.maximum(stop - 1, 0)]]] % 4
    else:
        text, stop, final = "", np.zeros(spans, np.int64), np.zeros(spans, np.int64)
    return [(text[b - n:b], int(f) if n else int(q)) for b, n, f, q in zip(stop, lengths, final, start, strict=True)]


def repairs(conversations: list[bytes]) -> Iterator[tuple[int, str]]:
    """(cost, edits) of conversations given as one code for each row: 4 * role class + fault."""
    size = np.array([len(c) for c in conversations], np.int64)
    codes = np.frombuffer(b"".join(conversations), np.uint8).astype(np.int64)
    first = np.cumsum(size) - size
    dist = costs(codes, first, size)
    base = first + np.arange(len(size))
    state = np.zeros(len(size), np.int64)
    pieces: list[list[str]] = [[] for _ in size]
    for lo in range(0, int(size.max(initial=1)), SPAN):
        some = np.flatnonzero((size > lo) | ((lo == 0) & (size == 0)))
        n = np.minimum(size[some] - lo, SPAN)
        take = np.concatenate([np.arange(a, a + k) for a, k in zip(first[some] + lo, n, strict=True)])
        nodes = np.concatenate([np.arange(a, a + k + 1) for a, k in zip(base[some] + lo, n, strict=True)])
        found = _ranked_paths(codes[take], n, dist[nodes], state[some], lo + n == size[some])
        for c, (text, q) in zip(some.tolist(), found, strict=True):
            pieces[c].append(text)
            state[c] = q
    return zip(dist[base, 0].tolist(), ["".join(p) for p in pieces], strict=True)


# --- rows -----------------------------------------------------------------------------------------------------------------------

def _filled(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) with faults put in by a hash of ``conv:turn``: of twenty rows about one is dropped, emptied, stripped
    of its sentence ends, repeated and given the role user each.  Nulls count as one space (a null turn stays null)."""
    kind = F.crc32(F.concat_ws(":", _filled(F.col(conv)), _filled(F.col(turn))).cast("binary")) % 20
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), _filled(F.col(role)).alias("role"),
                        _filled(F.col(text)).alias("text"), kind.alias("kind")).where("kind != 0")
    rows = rows.select("conv", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                       .otherwise(F.col("text")).alias("text"),
                       F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return rows.drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, at, code) of rows (conv, turn, role, text), written to the shared folder.

    ``at`` numbers the rows in the order of conversation, turn (nulls first), role, text; the rows of a conversation that lie in
    one sorted range have consecutive numbers.  ``code`` is 4 * role class + first fault."""
    spread = F.rand(13)         # equal rows may go to several ranges
    order = ["conv", F.asc_nulls_first("turn"), "role", "text"]
    ordered = staged(rows.withColumn("spread", spread).orderBy(*order, "spread").drop("spread")
                     .withColumn("at", F.monotonically_increasing_id()), "ordered-turns")
    said = F.rtrim(F.col("text"), F.lit(SPACES))
    blank = said == ""
    first = (ordered.where(~blank).groupBy("conv", "role", F.sha2("text", 256).alias("said")).agg(F.min("at").alias("first"))
             .select("first"))
    known = ordered.join(first, ordered["at"] == first["first"], "left")
    kind = F.when(F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) > 0, F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1).otherwise(3)
    kind = F.when(F.col("role") == "", F.lit(3)).otherwise(kind)
    fault = (F.when(blank, 1).when(F.col("first").isNull(), 2).when(~F.right(said, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0))
    return staged(known.select("conv", "turn", "role", "text", "at", (4 * kind + fault).cast("int").alias("code")), "faulty-turns")


def plans(coded: DataFrame) -> DataFrame:
    """(conv, cost, blank, duplicate, truncated, illegal, edits, runs) per conversation of ``faults``, written to the shared folder.

    ``edits``: one entry for each row, comma-joined: inserts before it (u, a), then K, D, U or A; inserts at the end follow the
    last entry.  ``runs``: the numbers ``at`` of its rows as array<struct<start, n>>."""
    spark = prepare(coded.sparkSession)
    run = F.shiftright("at", 12)            # 4096 consecutive numbers
    parts = coded.groupBy("conv", run.alias("run")).agg(
        F.min("at").alias("start"), F.array_sort(F.collect_list(F.struct("at", F.char(65 + F.col("code")).alias("c")))).alias("c"))
    parts = parts.select("conv", F.struct("start", F.size("c").alias("n"), F.array_join("c.c", "").alias("codes")).alias("part"))
    whole = parts.groupBy("conv").agg(F.array_sort(F.collect_list("part")).alias("parts")).select(
        "conv", F.array_join("parts.codes", "").alias("codes"),
        F.transform("parts", lambda p: F.struct(p["start"].alias("start"), p["n"].alias("n"))).alias("runs"))
    schema = (f"conv {coded.schema['conv'].dataType.simpleString()}, cost long, blank long, duplicate long, truncated long, illegal long, "
              "edits string, runs array<struct<start:long,n:int>>")
    names = ["conv", "cost", "blank", "duplicate", "truncated", "illegal", "edits", "runs"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_codes = [(np.frombuffer(c.encode(), np.uint8) - 65).astype(np.uint8).tobytes() for c in batch.column(1).to_pylist()]
            lo = 0
            while lo < len(all_codes):
                hi, n = lo + 1, len(all_codes[lo])
                while hi < len(all_codes) and n + len(all_codes[hi]) <= BLOCK_ROWS:
                    n += len(all_codes[hi])
                    hi += 1
                found = list(repairs(all_codes[lo:hi]))
                counts = np.array([_counts(c) for c in all_codes[lo:hi]], np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([c for c, _ in found], pa.int64()), *map(pa.array, counts.T),
                     pa.array([by_row(e) for _, e in found], pa.string()), batch.column(2).slice(lo, hi - lo)], names=names)
                lo = hi

    return staged(whole.select("conv", "codes", "runs").mapInArrow(work, schema), "repairs")


def _counts(codes: bytes) -> tuple[int, int, int, int]:
    c = np.frombuffer(codes, np.uint8)
    role, fault = c // 4, c % 4
    pair = role[:-1] * 4 + role[1:]
    legal = (pair == 1) | (pair == 6) | (pair == 9)          # su, ua, au
    return int((fault == 1).sum()), int((fault == 2).sum()), int((fault == 3).sum()), int((~legal).sum())


def by_row(edits: str) -> str:
    out, cut = [], 0
    for i, e in enumerate(edits):
        if e in "KDUA":
            out.append(edits[cut:i + 1])
            cut = i + 1
    if cut < len(edits):
        out[-1:] = [(out[-1] if out else "") + edits[cut:]]
    return ",".join(out)


def repaired(coded: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv, at, place, role, text) of the repaired rows; ``at``, ``place`` give their order inside a conversation."""
    rows = planned.select(F.explode(F.arrays_zip(
        F.flatten(F.transform("runs", lambda r: F.sequence(r["start"], r["start"] + r["n"] - 1))).alias("at"),
        F.split("edits", ",").alias("edit"))).alias("e")).select(F.col("e.at").alias("row"), F.col("e.edit").alias("edit"))
    met = coded.join(rows, coded["at"] == rows["row"])
    letters = met.select("conv", "at", "role", "text", F.posexplode(F.split("edit", "")).alias("place", "e")).where("e NOT IN ('', 'D')")
    role = F.when(F.col("e").isin("u", "U"), F.lit("user")).when(F.col("e").isin("a", "A"), F.lit("assistant")).otherwise(F.col("role"))
    return letters.select("conv", "at", "place", role.alias("role"), F.when(F.col("e").isin("u", "a"), F.lit("")).otherwise(F.col("text")).alias("text"))


def hashed(rows: DataFrame) -> DataFrame:
    """(conv, sha256) of ``role:text``, newline-joined, of ``repaired`` rows: one pass over sorted rows, holding one batch."""
    sorted_rows = (rows.select("conv", "at", "place", F.concat("role", F.lit(":"), "text").alias("line")).repartition("conv")
                   .sortWithinPartitions("conv", "at", "place").select("conv", "line"))
    schema = f"conv {rows.schema['conv'].dataType.simpleString()}, sha256 string"

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, began = None, None, False
        for batch in batches:
            done = []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if began and conv == now:
                    state.update(b"\n")
                else:
                    if began:
                        done.append((now, state.hexdigest()))
                    now, state, began = conv, hashlib.sha256(), True
                state.update(line.encode())
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], batch.column(0).type), pa.array([h for _, h in done], pa.string())],
                                             names=["conv", "sha256"])
        if began:
            yield pa.RecordBatch.from_arrays([pa.array([now], batch.column(0).type), pa.array([state.hexdigest()])], names=["conv", "sha256"])

    return sorted_rows.mapInArrow(work, schema)


def gaps(rows: DataFrame) -> DataFrame:
    """(conv, gaps): turns missing between the least and the largest one; 0 where all are null."""
    return rows.groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired rows of ``turns``: (conv, at, place, role, text).

    Nulls in role and text count as one space: such a text is blank, such a role neither system, user nor assistant.  Rows with
    equal turns go by role and text, null turns first; null conversation ids are one conversation; repeated rows are duplicates;
    other columns are not read; an empty table gives no rows."""
    coded = faults(turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), _filled(F.col(role)).alias("role"),
                                _filled(F.col(text)).alias("text")))
    return repaired(coded, plans(coded))


def report(turns: DataFrame, rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row for each conversation of ``turns``: faults found in ``rows`` (conv, turn, role, text; see ``damage``), cost, audit and
    hash of the repair; zeros, an empty audit and the hash of nothing where ``rows`` has none of it."""
    coded = faults(rows)
    planned = plans(coded)
    parts = [planned.select("conv", "blank", "duplicate", "truncated", "illegal", "cost", F.translate(
        F.col("edits"), "UAua,", "RRII").alias("audit")), gaps(coded), hashed(repaired(coded, planned))]
    out = turns.select(F.col(conv).alias("conv")).distinct()
    for i, p in enumerate(parts):
        p = p.withColumnRenamed("conv", f"conv{i}")
        out = out.join(p, out["conv"].eqNullSafe(p[f"conv{i}"]), "left").drop(f"conv{i}")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(F.col("conv").alias(conv), *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
