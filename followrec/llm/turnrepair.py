"""Conversation structure repair by weighted interval parsing (operator 13).

A conversation is repaired when its role initials spell ``(s?(ua)+)?``: an optional
system turn, then user and assistant in turn, or nothing at all. Every row is kept (0),
given the role user or assistant (3) or deleted (4, a must for blank and duplicate rows);
rows without text are inserted anywhere (3); a truncated row that stays costs 3 more.

Grammar. The pattern as an automaton has the places 0 (nothing yet), s, u and a. The
nonterminal ``pq`` derives the edits of a span of rows that lead from place p to place q,
in Chomsky normal form:

    pq -> pr rq     for every place r         (binary rules)
    pq -> one row   kept, rerole or deleted   (deletion leads from p to p)
    pq -> nothing   insertions only: the closure of single insertions over empty spans

The answer is the better of 00 and 0a over the whole conversation. A cell holds the least
(cost, audit) of its nonterminal over its span. Audits of equal cost over one span are
never proper prefixes of each other (the longer one would hold further insertions, which
cost), so the least audit of a concatenation is made of least audits and cells may be
combined from cells alone. As ``pq -> pr rq`` holds for every r, all cuts of a span give
the same cell: spans are combined bottom-up by length, each from one cut, which makes the
chart of n rows n - 1 combinations instead of n cubed.

On Spark: rows are numbered and staged; first occurrences come from a map-side grouping of
(conversation, role, text) digests; rows and marks of repeats are range-partitioned by
conversation and turn, so a conversation that holds a third of all rows is cut into many
slices. A task parses its slice in order. Conversations that begin and end inside a slice
are finished there; the cut ones, at most two a slice, leave one chart per slice, and
charts are combined by the same rule. Their repaired rows are then hashed in order by one
task for each, a batch at a time, since one SHA-256 cannot be computed in parts.

Defined results: a null role or text is one space, a null in the key of the damage too.
Rows of one turn go by role, text (its first 64 characters, then a digest). A null
conv_id is one conversation of its own. Roles other than s..., u..., a... fit no place:
such rows are given another role or deleted. Texts are compared and hashed whole. Empty
tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from followrec.llm.common import join_groups, stage

PLACES = "0sua"
#: Which place a role initial leads to: no row follows a system turn but a user's.
STEP = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
PAIRS = [p + q for p in PLACES for q in PLACES]
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
ROLE = {"u": "user", "a": "assistant"}

#: Least (cost, audit) of every nonterminal that derives the span.
Chart = dict[str, tuple[int, str]]

#: A span with more characters than this is closed early, which bounds a task's memory.
OPEN_BYTES = 16_000_000


def combine(x: Chart, y: Chart) -> Chart:
    """Cells of two neighbouring spans to those of their union: ``pq -> pr rq``."""
    out: Chart = {}
    for pr, (c, a) in x.items():
        for q in PLACES:
            right = y.get(pr[1] + q)
            if right is not None:
                cell = (c + right[0], a + right[1])
                if pr[0] + q not in out or cell < out[pr[0] + q]:
                    out[pr[0] + q] = cell
    return out


def _closure() -> Chart:
    """Cells of the empty span: no edit, or the cheapest insertions from place to place."""
    cells: Chart = {p + p: (0, "") for p in PLACES}
    for (p, x), q in STEP.items():
        if x in ROLE:
            cells[p + q] = (INSERT, "I")
    while (grown := combine(cells, cells)) != cells:
        cells = grown
    return cells


EMPTY = _closure()


@lru_cache(maxsize=1 << 14)
def _row(kind: str) -> Chart:
    """Cells of one row: a letter for its role (x: none that fits), then its fault."""
    role, fault = kind
    cells: Chart = {p + p: (DELETE, "D") for p in PLACES}
    if fault not in "bd":
        more = CUT_OFF if fault == "t" else 0
        for (p, x), q in STEP.items():
            if x == role:
                cells[p + q] = (KEEP + more, "K")
            elif x in ROLE:
                cells[p + q] = (REROLE + more, "R")
    return combine(combine(EMPTY, cells), EMPTY)


@lru_cache(maxsize=1 << 14)
def _short(kinds: str) -> Chart:
    return _parse(kinds)


def _parse(kinds: str) -> Chart:
    """Chart of a span, two characters a row: spans of 1, 2, 4, ... rows are combined."""
    if not kinds:
        return EMPTY
    level = [_row(kinds[i:i + 2]) for i in range(0, len(kinds), 2)]
    while len(level) > 1:
        pairs = [combine(x, y) for x, y in zip(level[::2], level[1::2])]
        level = pairs + level[len(pairs) * 2:]
    return level[0]


def parse(kinds: str) -> Chart:
    """Chart of the rows ``kinds``; the charts of short conversations are remembered."""
    return _short(kinds) if len(kinds) <= 32 else _parse(kinds)


def best(chart: Chart) -> tuple[int, str]:
    return min(chart[x] for x in ("00", "0a") if x in chart)


def repaired(audit: str, place: str, roles: list[str], texts: list[str]) -> tuple[list[str], str]:
    """Lines ``role:text`` that the edits leave, begun at ``place``, and the place reached."""
    lines, at = [], 0
    for edit in audit:
        if edit == "K":
            place = STEP[place, roles[at][0]]
            lines.append(f"{roles[at]}:{texts[at]}")
        elif edit != "D":
            place = "a" if place == "u" else "u"
            lines.append(f"{ROLE[place]}:{texts[at] if edit == 'R' else ''}")
        at += edit != "I"
    return lines, place


# ---------------------------------------------------------------- rows
#: Order of the rows in a conversation; ``row_no`` tells repeated rows apart.
ORDER = ["conv_id", "turn", "role", "head", "digest", "row_no"]
SPACES = " \t\n\x0b\x0c\r"


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` after the damage; a dropped row stays as one with ``gone`` set."""
    def spaced(c):
        return F.coalesce(c.cast("string"), F.lit(" "))

    conv, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    hit = F.crc32(F.concat_ws(":", spaced(conv), spaced(turn)).cast("binary")) % 20
    text = spaced(F.col("text"))
    return rows.select(
        conv.alias("conv_id"), turn.alias("turn"), (hit == 0).alias("gone"),
        F.when(hit == 4, "user").otherwise(spaced(F.col("role"))).alias("role"),
        F.when(hit <= 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text)
        .alias("text"),
        F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        .alias("copy")).drop("copy")


def intact(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` as they are, in the form of :func:`damaged`."""
    return rows.select(F.col("conv_id").cast("bigint").alias("conv_id"),
                       F.col("turn").cast("bigint").alias("turn"), F.lit(False).alias("gone"),
                       *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))


def _fault(text: Column) -> Column:
    """b blank, t truncated, o neither."""
    bare = F.rtrim(text, F.lit(SPACES))
    return (F.when(bare == "", "b").when(F.right(bare, F.lit(1)).isin(".", "!", "?"), "o")
            .otherwise("t"))


def _repeats(rows: DataFrame, total: int) -> DataFrame:
    """Order keys of the rows whose conversation, role and text stood earlier."""
    key = F.struct("turn", "row_no")  # null turns are the smallest
    seen = rows.where("not gone").select("content", *ORDER)
    first = (seen.groupBy("content").agg(F.min(key).alias("first"), F.count("*").alias("n"))
             .where("n > 1"))
    return (join_groups(seen, first, ["content"], "n", total).where(key > F.col("first"))
            .select(ORDER))


# ---------------------------------------------------------------- parsing
COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
#: What a task returns for a span: a finished conversation (``digest``) or a chart.
SPAN = pa.schema([
    ("conv_id", pa.int64()), ("rows", pa.int64()),
    *((c, pa.int64()) for c in COUNTS), ("low", pa.int64()), ("high", pa.int64()),
    ("initials", pa.string()), ("cost", pa.int64()), ("audit", pa.string()),
    ("sha", pa.string()), ("chart", pa.string()),
    ("turn", pa.int64()), ("role", pa.string()), ("head", pa.string()),
    ("digest", pa.binary()), ("row_no", pa.int64())])
SPAN_DDL = ("conv_id bigint, rows bigint, blank bigint, duplicate bigint, truncated bigint, "
            "illegal bigint, turns bigint, low bigint, high bigint, initials string, "
            "cost bigint, audit string, sha string, chart string, turn bigint, role string, "
            "head string, digest binary, row_no bigint")


def _written(chart: Chart) -> str:
    """``pq cost audit`` of every cell (audits are letters only)."""
    return ";".join(f"{k},{c},{a}" for k, (c, a) in sorted(chart.items()))


def _read(text: str) -> Chart:
    cells = (x.split(",") for x in text.split(";"))
    return {k: (int(c), a) for k, c, a in cells}


class Span:
    """The rows of one conversation that a task has read so far, in order."""

    def __init__(self, conv):
        self.conv, self.kinds, self.roles, self.texts = conv, [], [], []
        self.size, self.turns, self.first = 0, [], None

    def add(self, key: tuple, role: str, text: str, fault: str) -> None:
        self.first = self.first or key
        self.roles.append(role)
        self.texts.append(text)
        self.kinds.append((role[0] if role[:1] in ("s", "u", "a") else "x") + fault)
        self.turns.append(key[1])
        self.size += len(text)

    def row(self, finished: bool) -> dict:
        """One row of :data:`SPAN`; ``initials`` are the first and last, for the neighbours."""
        initials = [r[:1] for r in self.roles]
        numbers = [t for t in self.turns if t is not None]  # in order: equal ones adjoin
        kinds = "".join(self.kinds)
        faults = kinds[1::2]
        chart = parse(kinds)
        out = dict(
            conv_id=self.conv, rows=len(self.kinds), blank=faults.count("b"),
            duplicate=faults.count("d"), truncated=faults.count("t"),
            illegal=sum(x + y not in LEGAL for x, y in zip(initials, initials[1:])),
            turns=len(set(numbers)), low=min(numbers, default=None),
            high=max(numbers, default=None))
        if finished:
            cost, audit = best(chart)
            lines, _ = repaired(audit, "0", self.roles, self.texts)
            return out | dict(cost=cost, audit=audit, sha=hashlib.sha256(
                "\n".join(lines).encode()).hexdigest())
        out |= dict(initials=json.dumps(initials[:1] + initials[-1:]), chart=_written(chart))
        if self.first:
            out |= dict(zip(ORDER[1:], self.first[1:]))
        return out


def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of a slice. The first and the last conversation may go on in other slices."""
    out: list[dict] = []
    held, cut, marked = None, True, False

    def close(finished: bool) -> None:
        out.append(held.row(finished))

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in
                   (*ORDER, "kind", "text", "fault")]
        for *key, kind, text, fault in zip(*columns):
            if held is None or held.conv != key[0]:
                if held is not None:
                    close(not cut)
                    cut = False
                held = Span(key[0])
            if kind == "gone":  # the conversation is told of, without a row
                continue
            if kind == "mark":  # stands right before the row that it marks
                marked = True
                continue
            held.add(tuple(key), key[2], text, "d" if marked and fault != "b" else fault)
            marked = False
            if held.size > OPEN_BYTES:
                close(False)
                held, cut = Span(key[0]), True
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, SPAN)
            out = []
    if held is not None:
        close(False)
    if out:
        yield pa.RecordBatch.from_pylist(out, SPAN)


def _joined(parts: pa.Table) -> pa.Table:
    """The spans of one cut conversation, combined.

    One row a span with its own edits; the first one also has the conversation's counts
    and, in ``initials``, all its edits.
    """
    parts = sorted(parts.to_pylist(), key=lambda r: (
        r["row_no"] is not None, r["turn"] is not None, r["turn"] or 0, r["role"] or "",
        r["head"] or "", r["digest"] or b"", r["row_no"] or 0))
    charts = [_read(p["chart"]) for p in parts]
    chart, ahead = charts[0], [charts[0]]
    for c in charts[1:]:
        chart = combine(chart, c)
        ahead.append(chart)
    cost, audit = best(chart)
    # back from the end: the cells that the answer is made of
    cell, chosen = min((chart[x], x) for x in ("00", "0a") if x in chart)[1], []
    for k in range(len(charts) - 1, 0, -1):
        p = min((ahead[k - 1]["0" + r][0] + charts[k][r + cell[1]][0],
                 ahead[k - 1]["0" + r][1] + charts[k][r + cell[1]][1], r)
                for r in PLACES if "0" + r in ahead[k - 1] and r + cell[1] in charts[k])[2]
        chosen.append(p + cell[1])
        cell = "0" + p
    chosen = [cell, *chosen[::-1]]
    with_rows = [p for p in parts if p["rows"]]
    total = {c: sum(p[c] for p in parts) for c in COUNTS}
    for x, y in zip(with_rows, with_rows[1:]):
        pair = json.loads(x["initials"])[1] + json.loads(y["initials"])[0]
        total["illegal"] += pair not in LEGAL
        total["turns"] -= x["high"] is not None and x["high"] == y["low"]
    numbers = [v for p in parts for v in (p["low"], p["high"]) if v is not None]
    out = []
    for k, p in enumerate(parts):
        own = charts[k][chosen[k]]
        head = total | {"low": min(numbers, default=None), "high": max(numbers, default=None),
                        "cost": cost, "initials": audit} if k == 0 else dict.fromkeys(
            [*COUNTS, "low", "high", "cost", "initials"])
        out.append(p | head | {"audit": own[1], "chart": None})
    return pa.Table.from_pylist(out, SPAN)


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the repaired rows of each cut conversation, as its rows stream by.

    Before the rows of a span comes its row with ``audit``: the span's edits.
    """
    out, conv, state, edits, place, empty = [], None, None, [], "0", True
    schema = pa.schema([("conv", pa.int64()), ("sha", pa.string())])

    def emit(line: str) -> None:
        nonlocal empty
        state.update(("" if empty else "\n").encode() + line.encode())
        empty = False

    def inserted() -> None:
        """The insertions that come before the next row."""
        nonlocal place
        while edits and edits[-1] == "I":
            edits.pop()
            place = "a" if place == "u" else "u"
            emit(f"{ROLE[place]}:")

    def close() -> None:
        inserted()
        out.append({"conv": conv, "sha": state.hexdigest()})

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "audit")]
        for cid, role, text, audit in zip(*columns):
            if state is None or cid != conv:
                if state is not None:
                    close()
                conv, state, edits, place, empty = cid, hashlib.sha256(), [], "0", True
            inserted()
            if audit is not None:
                edits = list(audit[::-1])
                continue
            edit = edits.pop()
            if edit == "K":
                place = STEP[place, role[0]]
                emit(f"{role}:{text}")
            elif edit == "R":
                place = "a" if place == "u" else "u"
                emit(f"{ROLE[place]}:{text}")
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if state is not None:
        close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def repair(rows: DataFrame) -> DataFrame:
    """Repair of every conversation in the rows of :func:`damaged` or :func:`intact`.

    One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256.
    """
    rows = rows.select("conv_id", "turn", "role", "text", "gone")
    content = F.concat_ws("\n", F.coalesce(F.col("conv_id").cast("string"), F.lit("")),
                          F.length("role").cast("string"), "role", "text")
    rows = stage(rows.select(
        "*", F.substring("text", 1, 64).alias("head"),
        F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"),
        _fault(F.col("text")).alias("fault"),
        F.monotonically_increasing_id().alias("row_no")), "turns")
    seen = rows.withColumn("content", F.col("digest"))
    marks = _repeats(seen, rows.count())
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stream = (rows.select(*ORDER, F.when(F.col("gone"), "gone").otherwise("row").alias("kind"),
                          "text", "fault")
              .unionByName(marks.withColumn("kind", F.lit("mark")), allowMissingColumns=True)
              .repartitionByRange(n, *ORDER).sortWithinPartitions(*ORDER, "kind"))
    found = stage(stream.mapInArrow(spans, SPAN_DDL), "spans")
    done = found.where("chart is null")
    parts = stage(found.where("chart is not null").groupBy("conv_id")
                  .applyInArrow(_joined, SPAN_DDL), "cut")
    heads = parts.where("cost is not null")
    ids = F.broadcast(heads.select(F.col("conv_id").alias("cut_id")))
    lines = (rows.where("not gone").join(ids, F.col("conv_id").eqNullSafe(F.col("cut_id")),
                                         "left_semi")
             .select(*ORDER, "text", F.lit(None).cast("string").alias("audit"),
                     F.lit(1).alias("at"))
             .unionByName(parts.select(*ORDER, F.lit(None).cast("string").alias("text"), "audit",
                                       F.lit(0).alias("at"))))
    shas = (lines.repartition(n, "conv_id").sortWithinPartitions(*ORDER, "at")
            .mapInArrow(hashed, "conv bigint, sha string"))
    heads = (heads.drop("sha").withColumn("audit", F.col("initials"))
             .join(shas, F.col("conv_id").eqNullSafe(F.col("conv"))))
    result = done.select(SPAN.names).unionByName(heads.select(SPAN.names))
    return result.select(
        "conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
        .cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.col("sha").alias("repaired_sha256"))
