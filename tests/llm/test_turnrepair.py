"""Conversation repair against a plain search over all edit scripts' prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from followrec.llm import turnrepair
from followrec.llm.turnrepair import combine, damaged, parse, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, rows int"
SPACE = set("\t\n\x0b\x0c\r ")


def after_damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if hit == 1:
            text = ""
        elif hit == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        elif hit == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def cheapest(rows, faults):
    """Least (cost, audit): every edit script is walked left to right, the best of those
    that stand at the same row and place is carried on."""
    step = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    names = {"u": "user", "a": "assistant"}
    have = {"0": (0, "", ())}
    for i in range(len(rows) + 1):
        for _ in range(3):  # insertions before row i
            for p, (c, a, lines) in list(have.items()):
                for x in "ua":
                    if (p, x) in step:
                        q, new = step[p, x], (c + 3, a + "I", (*lines, names[x] + ":"))
                        have[q] = min(have.get(q, new), new)
        if i == len(rows):
            break
        role, text = rows[i]
        after = {}

        def put(q, new):
            after[q] = min(after.get(q, new), new)

        for p, (c, a, lines) in have.items():
            put(p, (c + 4, a + "D", lines))
            if faults[i] in ("blank", "duplicate"):
                continue
            cut = 3 if faults[i] == "truncated" else 0
            if (p, role[:1]) in step:
                put(step[p, role[:1]], (c + cut, a + "K", (*lines, f"{role}:{text}")))
            for x in "ua":
                if (p, x) in step:
                    put(step[p, x], (c + cut + 3, a + "R", (*lines, f"{names[x]}:{text}")))
        have = after
    return min(have[p] for p in ("0", "a") if p in have)


def brute(rows):
    convs = defaultdict(list, {r[0]: [] for r in rows})
    for conv, turn, role, text in after_damage(rows):
        convs[conv].append((turn is not None, turn or 0, role, text))
    out = {}
    for conv, have in convs.items():
        have.sort()
        faults, seen = [], set()
        for *_, role, text in have:
            solid = [c for c in text if c not in SPACE]
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen
                          else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for known, t, *_ in have if known]
        initials = [r[2][:1] for r in have]
        cost, audit, lines = cheapest([r[2:] for r in have], faults)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def messy(seed: int, convs: int, longest: int) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why", "", " \n", None, "a.b", "Größe?  ", "x" * 70 + "."]
    roles = ["user", "assistant", "system", "tool", None, "", "u", "\tx"]
    weights = [9, 9, 3, 1, 1, 1, 1, 1]
    out = []
    for c in range(convs):
        for t in range(rng.randint(1, longest)):
            turn = rng.choice([t, t, t, t, None, t + 3])
            out.append((c if c else None, turn, rng.choices(roles, weights)[0],
                        rng.choice(texts) if rng.random() < 0.5 else f"row {t} of {c}.", "x", 1))
    return out


def got(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


@pytest.mark.parametrize("slices", ["1", "7"])
def test_repair_equals_a_plain_search(spark, slices):
    rows = messy(3, 60, 9)
    rows += rows[5:9]  # repeated rows
    had = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    try:
        out = repair(damaged(spark.createDataFrame(rows, SCHEMA).repartition(3)))
        assert got(out) == brute(rows)
        assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal",
                               "cost", "audit", "repaired_sha256"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", had)


def test_a_long_conversation_is_cut_into_slices(spark):
    """One conversation with nearly all rows, over many slices; its result is that of the whole."""
    rng = random.Random(8)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"line {rng.randint(0, 300)}.", "", 0)
            for t in range(600)] + messy(4, 3, 4)
    had = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert got(repair(damaged(spark.createDataFrame(rows, SCHEMA)))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", had)


def test_a_span_of_many_bytes_is_closed_early():
    import pyarrow as pa
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", "", b"", t, "row", "x" * 40 + ".", "o")
            for t in range(8)]
    names = [*turnrepair.ORDER, "kind", "text", "fault"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])
    had, turnrepair.OPEN_BYTES = turnrepair.OPEN_BYTES, 100
    try:
        parts = pa.Table.from_batches(turnrepair.spans(iter([batch])))
    finally:
        turnrepair.OPEN_BYTES = had
    assert parts.num_rows == 3
    joined = turnrepair._joined(parts).to_pylist()
    assert [r["audit"] for r in joined] == ["KKK", "KKK", "KK"]
    assert (joined[0]["cost"], joined[0]["turns"], joined[0]["illegal"]) == (0, 8, 0)


def test_every_cut_of_a_span_gives_the_same_cells():
    rng = random.Random(5)
    for _ in range(60):
        kinds = "".join(rng.choice("suax") + rng.choice("ooobdt") for _ in range(rng.randint(1, 9)))
        whole = parse(kinds)
        for k in range(0, len(kinds) + 1, 2):
            assert combine(parse(kinds[:k]), parse(kinds[k:])) == whole


def test_empty_table_and_conversations_without_rows(spark):
    assert got(repair(damaged(spark.createDataFrame([], SCHEMA)))) == {}
    gone = next(t for t in range(99) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, gone, "user", "Hi.", "", 0)]
    empty = hashlib.sha256(b"").hexdigest()
    assert got(repair(damaged(spark.createDataFrame(rows, SCHEMA)))) == {
        5: (0, 0, 0, 0, 0, 0, "", empty)}
