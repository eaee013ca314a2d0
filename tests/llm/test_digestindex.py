"""The digest index against plain grouping, over one and several arrivals."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest

from followrec.llm.common import scratch_root
from followrec.llm.digestindex import DigestIndex, digest_of, exact_duplicates, new_documents

SCHEMA = "doc_id bigint, text string, digest string, keep_id string, row string"
ROWS = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "A"), (6, "é" * 50_000), (7, "é" * 50_000),
        (None, "a"), (None, "n"), (None, "n"), (8, "same row"), (8, "same row"), (9, " a")]
ROWS += [(i, "hot") for i in range(100, 160)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = Counter()
    for t, ids in groups.items():
        last = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        out[last, last, len(ids), True, sha] += 1
        ids.remove(last)
        out.update((i, last, len(ids) + 1, False, sha) for i in ids)
    return out


@pytest.mark.parametrize("arrivals", [1, 2, 5])
def test_exact_duplicates_equal_plain_grouping(spark, arrivals):
    got = exact_duplicates(frame(spark, ROWS), arrivals=arrivals)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == brute(ROWS)


def test_empty_table(spark):
    assert exact_duplicates(frame(spark, []).limit(0)).count() == 0


def test_new_documents_over_days_and_a_repeated_day(spark):
    path = f"{scratch_root(spark)}/index-days"
    days = [ROWS[:6], ROWS[3:] + [(70, "new")], [(71, "new"), (72, "newer"), (73, "newer")]]
    seen: set = set()
    for k, rows in enumerate(days):
        fresh = brute([r for r in rows if (r[1] or "") not in seen])
        want = Counter((r[0], r[4]) for r in fresh.elements() if r[3])
        for _ in range(2):  # a repeated arrival gives the same texts, entered once
            index = DigestIndex(spark, path, buckets=3)
            out = new_documents(frame(spark, rows), index, f"day-{k}")
            assert out.columns == SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")
            assert Counter((r[0], hashlib.sha256((r[1] or "").encode()).hexdigest())
                           for r in out.collect()) == want
        seen |= {r[1] or "" for r in rows}
        assert index.entries().count() == len(seen)
    small = index.compact(f"{path}-compact")
    assert sorted(r[0] for r in small.entries().collect()) == sorted(
        r[0] for r in index.entries().collect())
    # texts known from before: none of these rows is kept, the old id is named
    got = exact_duplicates(frame(spark, [(900, "new"), (901, "unheard")]), index).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {(900, 70, False), (901, 901, True)}


def test_the_index_side_is_neither_shuffled_nor_broadcast(spark):
    index = DigestIndex(spark, f"{scratch_root(spark)}/index-plan", buckets=5)
    groups = frame(spark, ROWS).select(digest_of("text").alias("digest")).distinct()
    index.append(frame(spark, ROWS).select("doc_id", digest_of("text").alias("digest")), "one")
    plan = index.unseen(groups)._jdf.queryExecution().executedPlan().toString().split("\n")
    join = next(i for i, line in enumerate(plan) if "SortMergeJoin" in line)
    depth = plan[join].index("SortMergeJoin") + len("+- ")
    branches = [i for i, line in enumerate(plan) if i > join and line[depth - 3:depth] in (":- ", "+- ")]
    assert any("Exchange" in line for line in plan[branches[0]:branches[1]])
    index_side = "\n".join(plan[branches[1]:])
    assert "Bucketed: true" in index_side and "Exchange" not in index_side
