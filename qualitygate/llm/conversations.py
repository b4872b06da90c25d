"""Repair of conversations whose turns are blank, repeated, cut off or out of role.

For each row and role automaton state the cheapest edits so far are known by cost and audit, the
string of their initials. Audits share their beginnings: an audit is a node that points to the one before it,
with ancestors at all powers of two and a rolling hash of the whole. Of equal costs the
ASCII-least audit wins; two audits are compared by a binary search for their longest common beginning, and
a beginning that hashes call common is verified.

Rows are sorted by conversation and turn over all tasks and cut into segments, so that a long conversation is
worked on in many tasks: a segment in the middle has the cheapest edits from each state to each. Only
these are put together where a conversation's segments meet.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitygate.llm.common import spool

#: States of the automaton of ``(s?(ua)+)?``: nothing yet, after system, after user, after assistant; the last and the first may end it.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
#: ASCII white space, and what ends a sentence.
WHITE, STOPS = " \t\n\v\f\r", ".!?"
#: Where a role's initial may be kept; what an inserted or renamed row becomes; pairs of initials that may follow each other.
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
#: Costs of edits.
RENAME, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
#: Rows and characters of a segment, at most (one row may have more); rows that a worker turns into Python objects at once.
SEGMENT_ROWS, SEGMENT_CHARACTERS, AT_ONCE = 2_000, 4_000_000, 200
#: Of the rolling hash.
MODULUS, BASE = (1 << 61) - 1, 1_000_003


class Audit:
    """A string that continues another one: the piece it adds, and where it comes from."""

    __slots__ = ("hash", "length", "mark", "piece", "up")

    def __init__(self, before: Audit | None = None, piece: str = "", mark=None):
        self.piece, self.mark, self.up = piece, mark, []
        self.length, self.hash = 0, 0
        if before is not None:
            self.length, self.hash, self.up = before.length + len(piece), _extended(before.hash, piece), [before]
            while len(self.up[-1].up) >= len(self.up):  # the 2^k-th ancestor's 2^k-th ancestor
                self.up.append(self.up[-1].up[len(self.up) - 1])

    def at(self, length: int) -> Audit:
        """The oldest beginning that is at least so long."""
        node = self
        for k in range(len(node.up) - 1, -1, -1):
            while len(node.up) > k and node.up[k].length >= length:
                node = node.up[k]
        return node

    def hash_of(self, length: int) -> int:
        """The hash of the first so many characters."""
        node = self.at(length)
        if node.length == length:
            return node.hash
        return _extended(node.up[0].hash, node.piece[: length - node.up[0].length])

    def character(self, place: int) -> str:
        node = self.at(place + 1)
        return node.piece[place - node.up[0].length]

    def chain(self) -> list[Audit]:
        nodes, node = [], self
        while node.up:
            nodes.append(node)
            node = node.up[0]
        return nodes[::-1]

    def __str__(self) -> str:
        return "".join(n.piece for n in self.chain())


def _extended(code: int, piece: str) -> int:
    for c in piece:
        code = (code * BASE + ord(c)) % MODULUS
    return code


def _verified(a: Audit, b: Audit, end: int) -> bool:
    """Whether the first ``end`` characters are equal, read backwards until both come from one node."""
    a, b = a.at(end), b.at(end)
    while end and a is not b:
        x, y = a.up[0].length, b.up[0].length
        start = max(x, y)
        if a.piece[start - x : end - x] != b.piece[start - y : end - y]:
            return False
        end, a, b = start, a.up[0] if x == start else a, b.up[0] if y == start else b
    return True


def common(a: Audit, b: Audit) -> int:
    """The length of the longest common beginning."""
    low, high = 0, min(a.length, b.length)
    while low < high:
        middle = (low + high + 1) // 2
        if a.hash_of(middle) == b.hash_of(middle):
            low = middle
        else:
            high = middle - 1
    if _verified(a, b, low):
        return low
    x, y = str(a), str(b)
    return next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))


def less(a: Audit, b: Audit) -> bool:
    """Whether ``a`` is before ``b`` in ASCII order."""
    if a is b:
        return False
    n = common(a, b)
    if n == min(a.length, b.length):
        return a.length < b.length
    return a.character(n) < b.character(n)


#: Cost and audit of the cheapest way to a state; None: there is none.
Best = list[tuple[int, Audit] | None]


def _offer(best: Best, state: int, cost: int, audit: Audit, piece: str, mark=None) -> None:
    held = best[state]
    if held is None or cost < held[0]:
        best[state] = (cost, Audit(audit, piece, mark))
    elif cost == held[0] and less(new := Audit(audit, piece, mark), held[1]):
        best[state] = (cost, new)


def _inserted(best: Best) -> Best:
    """With rows inserted here: one into the state after user, then one into that after assistant. More never pays."""
    for states in ((START, SYSTEM, ASSISTANT), (USER,)):
        for q in states:
            if best[q] is not None:
                _offer(best, NEXT[q], best[q][0] + INSERT, best[q][1], "I")
    return best


class Row(NamedTuple):
    role: str
    text: str
    turn: int | None
    fault: str  # b(lank), d(uplicate), t(runcated) or empty


def cheapest(rows: list[Row], start: int) -> Best:
    """The cheapest edits of ``rows`` that lead from the state ``start`` to each."""
    best: Best = [None] * len(STATES)
    best[start] = (0, Audit())
    _inserted(best)
    for row in rows:
        new: Best = [None] * len(STATES)
        for q in STATES:
            if best[q] is None:
                continue
            cost, audit = best[q]
            _offer(new, q, cost + DELETE, audit, "D")
            if row.fault not in ("b", "d"):
                extra = CUT_OFF * (row.fault == "t")
                if (to := KEEP.get((q, row.role[:1]))) is not None:
                    _offer(new, to, cost + extra, audit, "K")
                _offer(new, NEXT[q], cost + RENAME + extra, audit, "R")
        best = _inserted(new)
    return best


def ended(best: Best) -> tuple[int, Audit]:
    """The cheapest of the ways that may end here."""
    ends = [best[q] for q in (START, ASSISTANT) if best[q] is not None]
    if len(ends) == 2 and (ends[1][0] < ends[0][0] or (ends[1][0] == ends[0][0] and less(ends[1][1], ends[0][1]))):
        ends.reverse()
    return ends[0]


def repaired(rows: list[Row], audit: str, state: int = START) -> list[str]:
    """The lines ``role:text`` after the edits, beginning in ``state``."""
    lines, rest = [], iter(rows)
    for edit in audit:
        row = next(rest) if edit != "I" else None
        if edit == "D":
            continue
        if edit == "K":
            lines.append(f"{row.role}:{row.text}")
            state = KEEP[state, row.role[:1]]
        else:
            state = NEXT[state]
            lines.append(f"{NAMES[state]}:{row.text if row else ''}")
    return lines


def _figures(rows: list[Row]) -> dict:
    """What can be summed over segments, and what the sums need at their ends."""
    turns = [r.turn for r in rows if r.turn is not None]
    initials = [r.role[:1] for r in rows]
    return {
        "blank": sum(r.fault == "b" for r in rows),
        "duplicate": sum(r.fault == "d" for r in rows),
        "truncated": sum(r.fault == "t" for r in rows),
        "illegal": sum(x + y not in LEGAL for x, y in zip(initials, initials[1:], strict=False)),
        "rows": len(rows),
        "low": turns[0] if turns else None,
        "high": turns[-1] if turns else None,
        "turns": sum(x != y for x, y in zip(turns, [None, *turns], strict=False)),
        "head": initials[0] if rows else "",
        "tail": initials[-1] if rows else "",
    }


def _added(a: dict | None, b: dict) -> dict:
    """The figures of two neighbouring segments together."""
    if a is None or not a["rows"]:
        return b
    if not b["rows"]:
        return a
    both = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated", "illegal", "rows", "turns")}
    both["illegal"] += a["tail"] + b["head"] not in LEGAL
    both["turns"] -= a["high"] is not None and a["high"] == b["low"]
    both |= {"head": a["head"], "tail": b["tail"], "low": b["low"] if a["low"] is None else a["low"], "high": a["high"] if b["high"] is None else b["high"]}
    return both


def _answer(figures: dict | None, cost: int, audit: str, sha: str | None) -> dict:
    f = figures or _figures([])
    gaps = f["high"] - f["low"] + 1 - f["turns"] if f["low"] is not None else 0
    return {"gaps": gaps, **{k: f[k] for k in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost, "audit": audit, "repaired_sha256": sha}


#: Kinds of the rows that are sorted together: a mark that the row after it is a duplicate, a row, a conversation's sign that it exists.
DUPLICATE, PRESENT, ABSENT = range(3)
ANSWER = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
FIGURES = "blank long, duplicate long, truncated long, illegal long, rows long, low long, high long, turns long, head string, tail string"
#: A way through a segment: from a state to a state, at a cost, by an audit.
WAY = "from int, to int, cost long, audit string"
LINE = "role string, text string, turn long, fault string"


def _struct(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


def _table(rows: list[dict], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))


def _rows(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, AT_ONCE):
            yield from batch.slice(i, AT_ONCE).to_pylist()


def _segments(kind: T.DataType, most: int):
    """One row per conversation that lies within a task, answered; else one per segment, with its ways and lines."""
    fields = [T.StructField("conv_id", kind), T.StructField("part", T.IntegerType()), T.StructField("nth", T.IntegerType())]
    more = [T.StructField("answer", _struct(ANSWER)), T.StructField("figures", _struct(FIGURES)), T.StructField("ways", T.ArrayType(_struct(WAY))), T.StructField("lines", T.ArrayType(_struct(LINE)))]
    schema = T.StructType([*fields, *more])

    def run(batches):
        from pyspark import TaskContext

        part, nth, here, first, cut = TaskContext.get().partitionId(), 0, None, True, False
        rows, size, marked, begun, ready = [], 0, False, False, []

        def closed(whole: bool) -> None:
            nonlocal nth
            out = {"conv_id": here, "part": part, "nth": nth}
            if whole:
                cost, audit = ended(cheapest(rows, START))
                text = "\n".join(repaired(rows, str(audit)))
                out["answer"] = _answer(_figures(rows), cost, str(audit), hashlib.sha256(text.encode()).hexdigest())
            else:
                ways = [(q, to, best) for q in STATES for to, best in enumerate(cheapest(rows, q)) if best is not None]
                out["ways"] = [{"from": q, "to": to, "cost": best[0], "audit": str(best[1])} for q, to, best in ways]
                out |= {"figures": _figures(rows), "lines": [r._asdict() for r in rows]}
            nth += 1
            ready.append(out)

        for r in _rows(batches):
            if not begun or r["conv_id"] != here:
                if begun:
                    closed(whole=not first and not cut)
                    first = cut = False
                here, begun, rows, size = r["conv_id"], True, [], 0
            if r["kind"] == PRESENT:
                if len(rows) >= most or (rows and size + len(r["text"]) > SEGMENT_CHARACTERS):
                    closed(whole=False)
                    rows, size, cut = [], 0, True
                last = r["text"].rstrip(WHITE)[-1:]
                fault = "b" if not last else "d" if marked else "" if last in STOPS else "t"
                rows.append(Row(r["role"], r["text"], r["turn"], fault))
                size += len(r["text"])
            marked = r["kind"] == DUPLICATE
            if len(ready) == AT_ONCE or (ready and "lines" in ready[-1]):
                yield _table(ready, schema)
                ready.clear()
        if begun:
            closed(whole=False)  # it may go on in the next task
            yield _table(ready, schema)

    return run, schema


def _joined(kind: T.DataType):
    """A conversation's segments, in order, put together: its answer but for the hash (part -1), and each segment's audit and first state."""
    chosen = [T.StructField("state", T.IntegerType()), T.StructField("audit", T.StringType())]
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("part", T.IntegerType()), T.StructField("nth", T.IntegerType()), T.StructField("answer", _struct(ANSWER)), *chosen])

    def run(batches):
        here, best, figures, begun = None, None, None, False

        def closed() -> list[dict]:
            cost, audit = ended(best)
            rows = [{"conv_id": here, "part": -1, "nth": -1, "answer": _answer(figures, cost, str(audit), None)}]
            for node in audit.chain():
                part, nth, state = node.mark
                rows.append({"conv_id": here, "part": part, "nth": nth, "state": state, "audit": node.piece})
            return rows

        for r in _rows(batches):
            if not begun or r["conv_id"] != here:
                if begun:
                    yield _table(closed(), schema)
                here, begun, figures, best = r["conv_id"], True, None, [(0, Audit()), None, None, None]
            if r["figures"]["rows"]:
                figures, new = _added(figures, r["figures"]), [None] * len(STATES)
                for way in r["ways"]:
                    if best[way["from"]] is not None:
                        cost, audit = best[way["from"]]
                        _offer(new, way["to"], cost + way["cost"], audit, way["audit"], (r["part"], r["nth"], way["from"]))
                best = new
        if begun:
            yield _table(closed(), schema)

    return run, schema


def _lines_of(kind: T.DataType):
    """The repaired text of each segment; null if no line is left."""
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("part", T.IntegerType()), T.StructField("nth", T.IntegerType()), T.StructField("answer", _struct(ANSWER)), T.StructField("body", T.StringType())])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one segment at a time
                r = batch.slice(i, 1).to_pylist()[0]
                lines = repaired([Row(**x) for x in r["lines"]], r["audit"], r["state"])
                yield _table([{"conv_id": r["conv_id"], "part": r["part"], "nth": r["nth"], "body": "\n".join(lines) if lines else None}], schema)

    return run, schema


def _hashed(kind: T.DataType):
    """Each conversation's answer with the hash of its segments' texts, which come after it in order."""
    schema = T.StructType([T.StructField("conv_id", kind), *_struct(ANSWER).fields])

    def run(batches):
        head, sha, lines = None, None, False
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["answer"] is not None:
                    if head is not None:
                        yield _table([head | {"repaired_sha256": sha.hexdigest()}], schema)
                    head, sha, lines = {"conv_id": r["conv_id"]} | r["answer"], hashlib.sha256(), False
                elif r["body"] is not None:
                    sha.update(b"\n" * lines + r["body"].encode())
                    lines = True
        if head is not None:
            yield _table([head | {"repaired_sha256": sha.hexdigest()}], schema)

    return run, schema


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``present`` of each row, damaged by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops the row (``present`` is false), 1 empties its text, 2 removes ``[.!?]``, 3 repeats the row,
    4 sets the role user. A null counts as one space, in the key, as role and as text.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    h = F.pmod(F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")), F.lit(20))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    harmed = F.when(h == 1, "").when(h == 2, F.translate(text, STOPS, "")).otherwise(text)
    copies = F.explode(F.when(h == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return turns.select("conv_id", "turn", F.when(h == 4, "user").otherwise(role).alias("role"), harmed.alias("text"), (h != 0).alias("present"), copies.alias("copy")).drop("copy")


def repair(turns: DataFrame, present: Column | None = None, segment: int = SEGMENT_ROWS) -> DataFrame:
    """gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each conversation.

    ``turns`` has conv_id, turn, role and text; other columns are not looked at. Rows count by turn, nulls first;
    rows of one turn by role, then by the first 64 characters and the XXH64 of the text. A row's fault is
    the first that holds: blank (nothing but ASCII white space), duplicate (role and text came before),
    truncated (the last other character is none of ``.!?``). Edits: K(eep), R(ename to user or assistant) for 2, D(elete)
    for 3, I(nsert an empty row) for 2, and 1 for each truncated row that stays; blank and duplicate
    rows are deleted. What is left has roles by their initials ``(s?(ua)+)?`` at the least cost, of equal ones with
    the ASCII-least audit. Null role or text: one space. A null conv_id is a conversation like any other; rows
    that are not ``present`` only say that their conversation exists, and one without other rows has zeros,
    an empty audit and the hash of nothing. An empty table gives no rows.

    A conversation of any length is worked on by segments in many tasks. Only its
    audits, a few bytes a row, and in a stream its repaired text meet in one task, because one string and one
    SHA-256 are asked for.
    """
    spark, kind = turns.sparkSession, turns.schema["conv_id"].dataType
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    text = F.coalesce("text", F.lit(" "))
    columns = ["conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), here.alias("present")]
    rows = spool(turns.select(*columns).withColumn("row", F.monotonically_increasing_id()), "turns")
    rows = rows.withColumns({"head": F.substring("text", 1, 64), "digest": F.xxhash64("text")})
    # Of rows with the same role and text all but the first are marked. Texts are not moved for that.
    place = F.struct(F.col("turn").isNotNull().alias("named"), "turn", "row")
    own = rows.where("present").select("conv_id", "role", F.sha2("text", 256).alias("sha"), place.alias("place"), "head", "digest")
    again = own.groupBy("conv_id", "role", "sha").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = again.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("sha").alias("s"), "first")
    later = own.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("sha") == F.col("s"))).where("place > first")
    marks = later.select("conv_id", "place.turn", "role", F.lit("").alias("text"), "head", "digest", "place.row", F.lit(DUPLICATE).alias("kind"))
    only = lambda c, other: F.when(F.col("present"), F.col(c)).otherwise(other).alias(c)
    signs = rows.select("conv_id", "turn", "role", only("text", ""), only("head", None), only("digest", None), "row", F.when(F.col("present"), PRESENT).otherwise(ABSENT).alias("kind"))
    order = ["conv_id", "turn", "role", "head", "digest", "row"]
    run, schema = _segments(kind, segment)
    cut = spool(signs.unionByName(marks).repartitionByRange(parts, *order).sortWithinPartitions(*order, "kind").mapInArrow(run, schema), "segments")
    within = cut.where("answer is not null").select("conv_id", "answer.*")
    open_ = cut.where("answer is null")
    run, schema = _joined(kind)
    inner = ["conv_id", "part", "nth"]
    met = spool(open_.select(*inner, "figures", "ways").repartition(parts, "conv_id").sortWithinPartitions(*inner).mapInArrow(run, schema), "segments")
    run, schema = _lines_of(kind)
    texts = open_.select(*inner, "lines").join(met.select("part", "nth", "state", "audit"), ["part", "nth"]).select(*inner, "lines", "state", "audit")
    bodies = texts.mapInArrow(run, schema)
    heads = met.where("answer is not null").select(*inner, "answer", F.lit(None).cast("string").alias("body"))
    run, schema = _hashed(kind)
    return within.union(heads.union(bodies).repartition(parts, "conv_id").sortWithinPartitions(*inner).mapInArrow(run, schema))
