"""Repairs against a plain search over all edits, damage and faults against a loop over rows."""

import hashlib
import random
import re
import zlib
from functools import cache

from metassoc.llm import turn_repair as tr

SPACE = "\x20\x09-\x0D"


def plain_repair(rows):
    """rows: (role initial, fault) -> (cost, audit, [(letter, role)])"""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @cache
    def best(i, q, inserts):
        found = []
        if i == len(rows) and q in (0, 3):
            found.append((0, "", ()))
        if inserts < 3:
            for r in "ua":
                if (q, r) in step:
                    c, a, e = best(i, step[q, r], inserts + 1)
                    found.append((c + 2, "I" + a, (("I", r), *e)))
        if i < len(rows):
            role, fault = rows[i]
            c, a, e = best(i + 1, q, 0)
            found.append((c + 3, "D" + a, (("D", ""), *e)))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if (q, role) in step:
                    c, a, e = best(i + 1, step[q, role], 0)
                    found.append((c + more, "K" + a, (("K", role), *e)))
                for r in "ua":
                    if (q, r) in step:
                        c, a, e = best(i + 1, step[q, r], 0)
                        found.append((c + 2 + more, "R" + a, (("R", r), *e)))
        return min(found, key=lambda x: x[:2], default=(10**9, "", ()))

    return best(0, 0, 0)


def test_least_audits():
    rng = random.Random(1)
    some = [[(rng.choice("suax"), rng.choice(tr.FAULTS + ("none",) * 4)) for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 17, 40]))] for _ in range(400)]
    some.append([("u", "none"), ("a", "none")] * 60)
    codes = [bytes(4 * "suax".index(r) + tr.FAULTS.index(f) for r, f in rows) for rows in some]
    want = [plain_repair(tuple(r))[:2] for r in some]
    names = str.maketrans("UAua", "RRII")
    assert [(c, e.translate(names)) for c, e in tr.repairs(codes)] == want
    assert [(c, e.translate(names)) for one in codes for c, e in tr.repairs([one])] == want


def test_spans_of_a_long_conversation(monkeypatch):
    rng = random.Random(4)
    rows = [(rng.choice("uasx"), rng.choice(tr.FAULTS)) for _ in range(150)]
    code = bytes(4 * "suax".index(r) + tr.FAULTS.index(f) for r, f in rows)
    whole = list(tr.repairs([code, code[:64], code[:16]]))
    for span in (1, 7, 16):
        monkeypatch.setattr(tr, "SPAN", span)
        assert list(tr.repairs([code, code[:64], code[:16]])) == whole
    assert (whole[0][0], whole[0][1].translate(str.maketrans("UAua", "RRII"))) == plain_repair(tuple(rows))[:2]


def text_of(x):
    return " " if x is None else str(x)


def plain_damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = text_of(r), text_of(x)
        kind = zlib.crc32(f"{text_of(c)}:{text_of(t)}".encode()) % 20
        if kind == 0:
            continue
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        r = "user" if kind == 4 else r
        out += [(c, t, r, x)] * (2 if kind == 3 else 1)
    return out


def plain_report(conv, rows):
    rows = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, marked = set(), []
    for _, _, r, x in rows:
        bare = re.sub(f"[{SPACE}]+$", "", x)
        fault = "blank" if not bare else "duplicate" if (r, x) in seen else "none" if bare[-1] in ".!?" else "truncated"
        seen.add((r, x))
        marked.append((r[:1], fault))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:], strict=False))
    cost, audit, edits = plain_repair(tuple(marked))
    names, lines, left = {"u": "user", "a": "assistant"}, [], iter(rows)
    for letter, role in edits:
        row = None if letter == "I" else next(left)
        if letter != "D":
            lines.append(f"{row[2]}:{row[3]}" if letter == "K" else f"{names[role]}:{row[3] if row else ''}")
    count = lambda f: sum(x[1] == f for x in marked)
    return (conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_report_against_loops(spark):
    rng = random.Random(8)
    says = ["Yes.", "No!", "what?", "cut", "", None, " \t\n", "é ", "a.\x0b\x0c\r", "b\xa0", "x" * 50_000 + ".", "two\nlines."]
    rows = []
    for c in [*range(120), None]:
        for t in range(rng.randint(1, 12)):
            rows.append((c, rng.choice([t, t, t, t + 2, None]), rng.choice(["user", "assistant", "system", "tool", None, "", "User"]), rng.choice(says)))
    rows += rows[:40]
    rows += [(c, 0, "user", "all dropped.") for c in range(1000, 1100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    df = spark.createDataFrame([(*r, "clash", 3) for r in rows], "conv_id long, turn long, role string, text string, code string, at int").repartition(5)
    damaged = plain_damage(rows)
    assert sorted(map(str, damaged)) == sorted(str(tuple(r)) for r in tr.damage(df).collect())
    want = [plain_report(c, damaged) for c in dict.fromkeys(r[0] for r in rows)]
    got = [tuple(r) for r in tr.report(df, tr.damage(df)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(w[7] == "" for w in want)


def test_repaired_rows_of_a_large_conversation(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"said {i}.") for i in range(9000)]
    rows += [(1, 4500, "user", "said 4500."), (1, 9001, "user", "last?")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    got = tr.repair(df).orderBy("at", "place").collect()
    assert [(r.role, r.text) for r in got[:9000]] == [r[2:] for r in rows[:9000]]
    assert [(r.role, r.text) for r in got[9000:]] == [("user", "last?"), ("assistant", "")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert tr.report(df, tr.damage(df)).count() == 0 and tr.repair(df).count() == 0
