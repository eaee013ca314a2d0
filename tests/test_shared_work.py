"""Queries that read one result several times compute it once."""

import pytest

from followrec.operators import closest as cl
from followrec.operators import recommend as rc
from followrec.operators import reputation as rp
from followrec.plans import queries as q

SF = "/root/testdata/sf0.001"


@pytest.fixture
def calls(monkeypatch):
    """calls(module, name) counts from now on how often the operator is planned."""
    def count(module, name):
        seen, inner = [], getattr(module, name)

        def counted(*a, **kw):
            seen.append(name)
            return inner(*a, **kw)

        monkeypatch.setattr(module, name, counted)
        return seen

    return count


def test_run_days_are_shared_by_the_published_tables(spark, calls):
    closest, ranked = calls(cl, "closest_connections"), calls(rc, "ranked_from_active")
    scores = calls(rp, "reputation_scores")
    rows = {r.check_name: r.actual for r in q.REGISTRY["dq_report"](spark, SF).collect()}
    assert len(rows) == 9 and set(rows.values()) == {0}
    assert (len(closest), len(ranked), len(scores)) == (3, 3, 1)


def test_stage_counts_form_candidates_once(spark, calls):
    ranked, sums = calls(rc, "ranked_from_active"), calls(rc, "second_degree_sums")
    n = {r.stage: r.n for r in q.REGISTRY["stage_counts"](spark, SF).collect()}
    assert len(ranked) == 1 and len(sums) == 2
    assert n["kept_paths"] == q.REGISTRY["exclude_followed_self"](spark, SF).count()
    assert n["paths"] >= n["kept_paths"] >= n["candidates"] >= n["top_recommendations"]


def test_the_classifier_scores_the_model_input_that_it_was_fitted_on(spark, calls):
    tails, split = calls(rp, "padded_tails"), calls(rp, "tokens")
    classes = q.REGISTRY["classify_weeks"](spark, SF)
    assert len(tails) == 1 and len(split) == 1
    weeks = rp.user_weeks(q._clean(spark, SF))
    assert classes.count() == weeks.count() == classes.select(*rp.WEEK_KEY).distinct().count()
