import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from qualitygate.llm import conversations as cv

WORDS = ["Hi.", "Well", "No!", "", " \n", "Why?  ", "Hi.", "a b", "ok"]
ROLES = ["user", "assistant", "system", "tool", "", "umpire"]


def damage(rows):
    """(conv_id, turn, role, text, position) of what is left."""
    out = []
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
    return out


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        out.append("b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def least(rows, marks):
    """(cost, audit) by strings, from the last row backwards."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    after = {"": (0, ""), "a": (0, "")}
    for i in range(len(rows), -1, -1):
        here = dict(after) if i == len(rows) else {}
        if i < len(rows):
            for q in ("", "s", "u", "a"):
                options = [(after[q][0] + 3, "D" + after[q][1])] if q in after else []
                if marks[i] not in ("b", "d"):
                    extra = marks[i] == "t"
                    to = step.get((q, rows[i][0][:1]))
                    options += [(after[to][0] + extra, "K" + after[to][1])] if to in after else []
                    to = "a" if q == "u" else "u"
                    options += [(after[to][0] + 2 + extra, "R" + after[to][1])] if to in after else []
                if options:
                    here[q] = min(options)
        for _ in range(4):
            for q in ("", "s", "u", "a"):
                to = "a" if q == "u" else "u"
                if to in here:
                    here[q] = min(here.get(q, (10**9, "")), (here[to][0] + 2, "I" + here[to][1]))
        after = here
    return after[""]


def lines(rows, audit):
    out, i, state = [], 0, ""
    for edit in audit:
        if edit in "RI":
            state = "a" if state == "u" else "u"
            out.append({"u": "user", "a": "assistant"}[state] + ":" + (rows[i][1] if edit == "R" else ""))
        elif edit == "K":
            state = rows[i][0][0]
            out.append(f"{rows[i][0]}:{rows[i][1]}")
        i += edit != "I"
    return "\n".join(out)


def by_force(given):
    out = {}
    left = damage(given)
    for conv in {r[0] for r in given}:
        own = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        rows = [r[2:] for r in own]
        marks = faults(rows)
        turns = {r[1] for r in own} - {None}
        illegal = sum(x[0][:1] + y[0][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:], strict=False))
        cost, audit = least(rows, marks)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, marks.count("b"), marks.count("d"), marks.count("t"), illegal, cost, audit, hashlib.sha256(lines(rows, audit).encode()).hexdigest())
    return out


def result(df):
    got = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: r[1:] for r in got}


def test_reference_against_all_edit_sequences():
    rnd = random.Random(2)
    for _ in range(60):
        rows = [(rnd.choice(ROLES), rnd.choice(WORDS)) for _ in range(rnd.randint(0, 3))]
        marks, found = faults(rows), []
        for n in range(2 * len(rows) + 4):
            for edits in product("DIKR", repeat=n):
                if sum(e != "I" for e in edits) != len(rows) or n > len(rows) + 3:
                    continue
                cost, state, i, fine = 0, "", 0, True
                for e in edits:
                    if e == "I":
                        cost, state = cost + 2, "a" if state == "u" else "u"
                        continue
                    if e == "D":
                        cost += 3
                    else:
                        initial = rows[i][0][:1] if e == "K" else "a" if state == "u" else "u"
                        fine &= marks[i] not in ("b", "d") and (initial == "a" if state == "u" else initial == "u" or (initial == "s" and state == ""))
                        cost, state = cost + (2 if e == "R" else 0) + (marks[i] == "t"), initial
                    i += 1
                if fine and state in ("", "a"):
                    found.append((cost, "".join(edits)))
        assert least(rows, marks) == min(found)


@pytest.mark.parametrize("modulus", [cv.MODULUS, 3])
def test_dynamic_programme_and_segments_against_strings(monkeypatch, modulus):
    monkeypatch.setattr(cv, "MODULUS", modulus)  # 3: nearly all comparisons collide
    rnd = random.Random(modulus)
    for _ in range(150):
        rows = [(rnd.choice(ROLES), rnd.choice(WORDS)) for _ in range(rnd.randint(0, 25))]
        marks = faults(rows)
        made = [cv.Row(r, t, i, m) for i, ((r, t), m) in enumerate(zip(rows, marks, strict=True))]
        cost, audit = cv.ended(cv.cheapest(made, cv.START))
        assert (cost, str(audit)) == least(rows, marks)
        assert "\n".join(cv.repaired(made, str(audit))) == lines(rows, str(audit))


def test_comparison_of_audits(monkeypatch):
    for modulus in (cv.MODULUS, 2):
        monkeypatch.setattr(cv, "MODULUS", modulus)
        rnd, nodes = random.Random(4), [cv.Audit()]
        for _ in range(300):
            nodes.append(cv.Audit(rnd.choice(nodes[-20:]), "".join(rnd.choice("DK") for _ in range(rnd.randint(0, 3)))))
        for _ in range(2000):
            a, b = rnd.choice(nodes), rnd.choice(nodes)
            assert cv.less(a, b) == (str(a) < str(b))


def test_conversations_against_brute_force(spark, many_partitions):
    rnd = random.Random(11)
    given = [(c, t, rnd.choice(ROLES), rnd.choice(WORDS)) for c in range(120) for t in range(rnd.randint(1, 9)) if rnd.random() < 0.9]
    given += [(500, t, rnd.choice(["user", "assistant", "assistant"]), f"{rnd.choice(WORDS)}{t % 90}{rnd.choice('.! x')}") for t in range(700)]
    given += [(None, None, None, None), (None, 3, "user", "x"), (None, None, "user", "Hi."), (7, None, "assistant", "é" * 100000 + "."), (7, 4, "user", "Hi."), (7, 4, "user", "Hi."), (7, 4, "user", None)]
    given += [(800, None, "user", "same.")] * 40
    rnd.shuffle(given)
    table = spark.createDataFrame([(*r, "x", 1) for r in given], "conv_id long, turn long, role string, text string, kind string, row int")
    want = by_force(given)
    for segment in (5, cv.SEGMENT_ROWS):
        assert result(cv.repair(cv.damaged(table), F.col("present"), segment=segment)) == want
    assert cv.repair(cv.damaged(table.limit(0)), F.col("present")).count() == 0


def test_whole_table_against_brute_force(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert result(cv.repair(cv.damaged(turns), F.col("present"))) == by_force([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])


def test_conversations_without_rows(spark):
    table = spark.createDataFrame([("a", 1, "user", "x", False), ("b", None, "user", "x.", True)], "conv_id string, turn int, role string, text string, here boolean")
    got = result(cv.repair(table, F.col("here")))
    assert got["a"] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got["b"] == (0, 0, 0, 0, 0, 2, "KI", hashlib.sha256(b"user:x.\nassistant:").hexdigest())
