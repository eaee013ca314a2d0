"""Step 2: cleaning (E14), links (E13), week bins (L13), model input (M1-M3)."""

import re
import string
from datetime import date, timedelta

from pyspark.sql import functions as F

from followrec.functions import clean_text, first_link_description, week_bin
from followrec.operators import reputation as rp
from followrec.params import Params
from followrec.sources.schemas import MESSAGE_JSON

P = Params()


def py_clean(s: str) -> str:
    """The cleaning rules with Python's re, as an independent check."""
    s = re.sub(r"@\w+", "", s)
    s = re.sub(r"https?://[^\s]+", "http", s)
    s = re.sub("[" + re.escape(string.punctuation) + "]", "", s)
    s = re.sub(r"[^\x00-\x7F]", "", s)
    s = re.sub(r"\d+", "", s)
    return s.lower()


ADVERSARIAL = [
    "@joséx hi $AAPL 12",
    "see https://a.b/c?d=1 tail",
    "a_b+c<d>|x~y`z=w^v",
    "u@x.com \U0001F600 ٣ done",
    "@áb z",
    "Mixed CASE @user_1 http://x.y/z, and https://q.r/s!",
    "tabs\tand\nnewlines 3.14 $$ %%",
    "",
]


def test_clean_matches_python_rules(spark):
    df = spark.createDataFrame([(s,) for s in ADVERSARIAL], "t string")
    got = [r[0] for r in df.select(clean_text("t")).collect()]
    assert got == [py_clean(s) for s in ADVERSARIAL]


def test_first_link_description(spark):
    rows = [(1, None), (2, []), (3, [{"description": None}]),
            (4, [{"description": "d1"}, {"description": "d2"}])]
    df = spark.createDataFrame(rows, "id long, links array<struct<description:string>>")
    got = dict(df.select("id", first_link_description("links")).collect())
    assert got == {1: "", 2: "", 3: "", 4: "d1"}


def test_week_bins_right_closed(spark):
    df = spark.createDataFrame([(d,) for d in (-1, 0, 1, 7, 8, 364, 365)], "d int")
    got = [r[0] for r in df.select(week_bin("d", 7, 364)).collect()]
    assert got == [None, None, 0, 0, 1, 51, None]


def _messages(spark, rows):
    """rows: (user_id, msg_id, day, body, recommended)."""
    data = []
    for u, m, day, body, rec in rows:
        d = P.anchor_date + timedelta(days=day)
        data.append((u, m, body, f"{d:%Y-%m-%d}T10:00:00Z", rec, None))
    return spark.createDataFrame(data, MESSAGE_JSON)


def test_weekly_text_and_scores(spark):
    msgs = _messages(spark, [
        (1, 2, 3, "Second $MSG", 1), (1, 1, 3, "First!", None), (1, 3, 8, "next week", 0),
        (2, 4, 0, "day zero is outside", 1), (2, 5, 365, "so is 365", 1)])
    clean = rp.clean_messages(rp.message_frame(msgs, P))
    wt = {(r.user_id, r.week_idx): r for r in rp.weekly_text(clean, P).collect()}
    assert set(wt) == {(1, 0), (1, 1)}
    assert wt[(1, 0)].clean_body == "first second msg"
    assert wt[(1, 0)].week_start == date(2018, 9, 10)
    assert wt[(1, 0)].week_end == date(2018, 9, 16)
    scores = dict(rp.reputation_scores(spark, msgs, P).collect())
    # week 0: share 1.0 -> 1; week 1: share 0.0 -> 0; user 2 has no binned week
    assert scores == {1: 0.5}


def test_vocabulary_sequences_padding(spark):
    p = P.with_(vocab_size=4, seq_len=5)
    msgs = _messages(spark, [
        (1, 1, 1, "b a a c d", 1), (1, 2, 2, "c a b", None),
        (2, 3, 1, "zz a", None)])
    clean = rp.clean_messages(rp.message_frame(msgs, p))
    vocab = {r.token: r.token_index for r in rp.token_vocabulary(clean, p).collect()}
    # counts over the labelled week of user 1: a 3, b 2, c 2, d 1; ties by word
    assert vocab == {"a": 1, "b": 2, "c": 3}
    enc = rp.encode_sequences(clean, rp.token_vocabulary(clean, p))
    seq = sorted((r.user_id, r.seq_pos, r.token_index) for r in enc.collect())
    assert [s[2] for s in seq if s[0] == 1] == [2, 1, 1, 3, 3, 1, 2]
    _, padded = rp.model_input(clean, p)
    pad = {r.user_id: list(r.sequence) for r in padded.collect()}
    assert pad[1] == [1, 3, 3, 1, 2]          # last 5 known words
    assert pad[2] == [0, 0, 0, 0, 1]          # 'zz' unknown, zeros in front


def test_only_the_tail_of_a_week_is_split(spark):
    """Of 60 messages of one week, those that end before the last seq_len words are left out."""
    p = P.with_(vocab_size=100, seq_len=25)
    rows = [(1, i, 1 + i % 7, " ".join(f"{'xyz'[k % 3]}" for k in range(i % 5)), 1)
            for i in range(60)]
    clean = rp.keyed_messages(rp.clean_messages(rp.message_frame(_messages(spark, rows), p)))
    vocab = rp.token_vocabulary(clean, p)
    ids = {r.token: r.token_index for r in vocab.collect()}
    tail = rp.tail_messages(rp.message_offsets(clean, vocab), p).collect()
    assert sum(r.take for r in tail) == 25
    assert sum(r.n_known for r in tail) <= 25 + max(r.n_known for r in tail)
    in_order = sorted(rows, key=lambda r: (r[2], r[1]))
    words = [ids[w] for r in in_order for w in r[3].split()]
    _, padded = rp.model_input(clean, p)
    got = padded.collect()[0]
    assert (got.n_tokens, list(got.sequence)) == (len(words), words[-25:])


def test_model_file_is_loaded_once_per_worker(spark, tmp_path):
    model, log = tmp_path / "model.txt", tmp_path / "loads"
    model.write_text("0.25")
    log.mkdir()

    def load(path):
        import os
        import uuid
        (log / f"{os.getpid()}-{uuid.uuid4().hex}").write_text("")
        value = float(open(path).read())
        return lambda x: [value] * len(x)

    p = P.with_(vocab_size=10, seq_len=4)
    msgs = _messages(spark, [(u, u, 1 + u % 5, "a b c", 1) for u in range(200)])
    clean = rp.clean_messages(rp.message_frame(msgs, p))
    scored = rp.model_file_scorer(str(model), load, batch_size=3)(spark, clean, p)
    for _ in range(3):  # many batches and several jobs
        assert {r.probability for r in scored.repartition(8).collect()} == {0.25}
    loads = [f.name.split("-")[0] for f in log.iterdir()]
    assert loads and len(loads) == len(set(loads))


def test_area_under_the_curve_counts_ties_half(spark):
    rows = [(0.9, 1), (0.7, 1), (0.7, 0), (0.7, 0), (0.2, 1), (0.1, 0)]
    df = spark.createDataFrame([(p, float(x)) for p, x in rows],
                               "probability double, label double")
    wins = sum((a > b) + (a == b) / 2 for a, x in rows for b, y in rows if x == 1 and y == 0)
    got = rp.area_under_curve(df).collect()[0]
    assert (got.n1, got.n0) == (3, 3) and abs(got.auc - wins / 9) < 1e-12
    assert rp.area_under_curve(df.filter("label = 1")).collect()[0].auc is None


def test_sequences_do_not_need_message_ids(spark):
    p = P.with_(vocab_size=4, seq_len=5)
    for first, second, other in ((None, None, None), (7, 7, 7)):
        msgs = _messages(spark, [(1, first, 1, "b a a c d", 1), (1, second, 2, "c a b", None),
                                 (2, other, 1, "zz a", None)])
        clean = rp.clean_messages(rp.message_frame(msgs, p))
        _, padded = rp.model_input(clean, p)
        got = {r.user_id: (r.n_tokens, list(r.sequence)) for r in padded.collect()}
        assert got == {1: (7, [1, 3, 3, 1, 2]), 2: (1, [0, 0, 0, 0, 1])}


def test_batch_model_scorer_runs_in_batches(spark):
    import numpy as np
    calls = []

    def predict(x):
        calls.append(x.shape)
        return (x > 0).sum(axis=1) / x.shape[1]

    p = P.with_(vocab_size=10, seq_len=4)
    msgs = _messages(spark, [(u, u, 1 + u % 5, "a b c d e f" if u % 2 else "a", 1)
                             for u in range(20)])
    clean = rp.clean_messages(rp.message_frame(msgs, p))
    probs = rp.batch_model_scorer(predict, batch_size=3)(spark, clean, p)
    got = {r.user_id: r.probability for r in probs.collect()}
    assert got[1] == 1.0 and got[2] == 0.25
    assert np.isfinite(list(got.values())).all()


def test_spark_ml_scorer_probabilities(spark):
    p = P.with_(vocab_size=50, seq_len=10)
    rows = []
    for u in range(40):
        good = u % 2 == 0
        rows.append((u, u, 1 + u % 50, "gain profit up" if good else "spam scam junk", int(good)))
    clean = rp.clean_messages(rp.message_frame(_messages(spark, rows), p))
    probs = rp.SparkMLScorer(max_iter=20)(spark, clean, p)
    got = {r.user_id: r.probability for r in probs.collect()}
    assert len(got) == 40
    assert all(got[u] > 0.5 for u in range(0, 40, 2))
    assert all(got[u] < 0.5 for u in range(1, 40, 2))
    assert F  # keep import used


def test_separate_training_messages_and_saved_model(spark, tmp_path):
    p = P.with_(vocab_size=50, seq_len=10)
    train = _messages(spark, [(u, u, 1 + u % 50, "gain profit" if u % 2 == 0 else "scam junk",
                                int(u % 2 == 0)) for u in range(40)])
    test = _messages(spark, [(100, 1000, 3, "profit gain gain", None),
                             (101, 1001, 3, "junk scam", None), (102, 1002, 3, "unseen", None)])
    scorer = rp.SparkMLScorer(max_iter=20, model_path=str(tmp_path / "model"))
    scores = dict(rp.reputation_scores(spark, test, p, scorer, training_messages=train).collect())
    assert scores[100] == 1.0 and scores[101] == 0.0 and set(scores) == {100, 101, 102}
    # a second run loads the saved model and vocabulary instead of fitting
    again = dict(rp.reputation_scores(spark, test, p, scorer).collect())
    assert again == scores


def test_notebook_bin_variant(spark):
    # the exploration notebook bins from 2015-12-08 up to day 189
    p = P.with_(anchor_date=date(2015, 12, 8), max_day=189)
    df = spark.createDataFrame([(d,) for d in (0, 1, 189, 190)], "d int")
    got = [r[0] for r in df.select(week_bin("d", p.bin_days, p.max_day)).collect()]
    assert got == [None, 0, 26, None]
