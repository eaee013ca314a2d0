"""Collocations against DuckDB SQL, which counts every phrase."""

from __future__ import annotations

import random

import duckdb
import pytest

from followrec.llm import collocations
from followrec.llm.collocations import ORACLE_SQL, PhraseParams, mine

SCHEMA = "doc_id bigint, text string, lang string, a bigint, phrase string"


def texts() -> list[tuple]:
    rng = random.Random(2)
    words = ["The", "of", "red", "Fox", "ran", "ÄB", "é", "x\x1cy", "z-1"]
    weights = [30, 20, 8, 8, 6, 4, 4, 2, 2]
    fixed = ["new york city hall", "la la la la la", "a b c d", "b c", "over  the\ttop"]
    out: list[str | None] = [None, "", " \t ", ".!?;:,", "one", "end\x0b"]
    for _ in range(260):
        row = [rng.choice(fixed) if rng.random() < 0.25 else rng.choices(words, weights)[0]
               for _ in range(rng.randint(1, 30))]
        out.append("".join(w + rng.choice([" ", " ", " ", ". ", "\n", "  "]) for w in row))
    langs = ["en", "en", "en", "fr", None, "und"]
    rows = [(i, t, langs[i % 6], 7, "clash") for i, t in enumerate(out)]
    return rows + rows[10:40]  # repeated rows


@pytest.mark.parametrize("least, keep", [(30, 2000), (3, 25), (5, 4)])
def test_equal_to_counting_all_phrases(spark, least, keep):
    import pandas as pd
    rows = texts()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "a", "phrase"]))
    sql = ORACLE_SQL.replace("f >= 30", f"f >= {least}").replace("rank <= 2000", f"rank <= {keep}")
    want = con.execute(sql).fetchall()
    got = mine(spark.createDataFrame(rows, SCHEMA).repartition(3),
               PhraseParams(least=least, keep=keep))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and want


def test_small_bitmaps_and_slices_change_nothing(spark):
    df = spark.createDataFrame(texts(), SCHEMA).repartition(2)
    want = sorted(tuple(r) for r in mine(df, PhraseParams(least=4, keep=10)).collect())
    had, collocations.SLICE_BYTES = collocations.SLICE_BYTES, 300
    try:
        got = mine(df, PhraseParams(least=4, keep=10, bits=64, slack=0.0))
        assert sorted(tuple(r) for r in got.collect()) == want
    finally:
        collocations.SLICE_BYTES = had


def test_long_text_and_empty_table(spark):
    long = spark.createDataFrame([(1, "w1 w2 " * 100_000 + "q" * 100_000, "en", 0, "")], SCHEMA)
    got = {(r.phrase, r.a) for r in mine(long).collect()}
    # a phrase of four words has nearly all occurrences of the shorter ones, which go
    assert got == {("w1 w2 w1 w2", 99_999), ("w2 w1 w2 w1", 99_998)}
    assert mine(long.limit(0)).count() == 0
