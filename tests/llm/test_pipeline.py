"""The pipeline's stages on clashing columns, nulls, near copies and empty tables."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from followrec.llm import setsketch
from followrec.llm.common import maybe_among

CLASHES = ["score", "held_out", "predicted", "n_lines", "n_dropped", "many", "d", "text_key",
           "key", "row", "k", "comp", "host", "a.b"]
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory) -> str:
    rng = random.Random(5)
    texts: list = [None, "", "one two"]
    texts += [_words(rng, 60) + "\nfooter of every page here" for _ in range(40)]
    texts += [texts[5], texts[5]]
    texts += [("## $$ %% && " * 20) + _words(rng, 5) for _ in range(20)]
    rows = [(i, t, "en", "s", len(t or ""), *(f"{c} {i}" for c in CLASHES))
            for i, t in enumerate(texts)]
    rows.append((None, texts[6], None, None, None, *([None] * len(CLASHES))))
    extra = ", ".join(f"`{c}` string" for c in CLASHES)
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, f"{DOCS}, {extra}").write.parquet(f"{path}/documents.parquet")
    labels = [(i, int("##" not in (t or "")), 0) for i, t in enumerate(texts)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet")
    spark.createDataFrame([(1, texts[8].split("\n")[0])], "item_id bigint, text string"
                          ).write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_keep_further_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, folder), f"test-{name}")
        assert docs.columns == names, name
        for r in docs.collect():
            assert r[5:] == before[r.doc_id][5:], name
        ids = {r.doc_id for r in docs.collect()}
        if name == "quality":
            assert set(range(3, 45)) <= ids and not ids & set(range(45, 65))
        if name == "line_dedup":
            assert all("footer" not in (r.text or "") for r in docs.where("doc_id > 2").collect())
        if name == "near_duplicates":
            assert 5 in ids and not ids & {43, 44}
        if name == "decontamination":
            assert 8 not in ids and set(range(9, 43)) <= ids


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    ids = {r.doc_id for r in got.collect()}
    assert set(range(9, 43)) <= ids and not ids & {8, 43, 44, *range(45, 65)}


def test_run_on_empty_tables(spark, tmp_path):
    for name, schema in (("documents", DOCS), ("labels", "doc_id bigint, quality int, toxic int"),
                         ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_keep_their_lines(spark):
    """20 documents that differ in one line of 21, among 80 others of one source."""
    rng = random.Random(3)
    base = [_words(rng, 10) for _ in range(21)]
    texts = ["\n".join([*base[:k], _words(rng, 2), *base[k + 1:]]) for k in range(20)]
    texts += [_words(rng, 100) + "\nthe same menu on every page" for _ in range(80)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)
    cleaned = corpus_pipeline.line_dedup(spark, docs, "")
    got = {r.doc_id: r.text for r in cleaned.collect()}
    assert all(got[i] == texts[i] for i in range(20))
    assert all(got[i] == texts[i].split("\n")[0] for i in range(20, 100))
    left = corpus_pipeline.near_duplicates(spark, cleaned, "")
    assert {r.doc_id for r in left.collect()} == {0, *range(20, 100)}


def test_bitmap_loses_no_match(spark):
    rows = spark.range(5000).selectExpr("nullif(id, 7) AS a", "id % 10 AS b", "id AS c")
    keys = rows.where("c % 50 = 7").select("a", "b")
    for bits in (1 << 15, 1 << 20):
        got = {r.c for r in maybe_among(rows, keys, ["a", "b"], bits).collect()}
        assert set(range(7, 5000, 50)) <= got and len(got) < 1500


def test_rows_of_a_representative_may_repeat(spark):
    texts = ["a b c d e f g h i j k l m n o p q r s t u v w x y z"] * 3
    docs = spark.createDataFrame([(1, t) for t in texts] + [(2, texts[0] + " zz")],
                                 "doc_id bigint, text string")
    got = setsketch.near_duplicates(docs).collect()
    assert len(got) == 4 and {r.component_id for r in got} == {1}
