"""Step 2: author reputation from weekly message text.

Messages are cleaned with built-in regex expressions, binned into right-closed
7-day weeks from an anchor date and grouped per (user, week). A scorer gives
each user-week a probability; the week is positive at >= 0.5 and a user's
score is the share of positive weeks.

The text model's input is the last `seq_len` known words of a week. Messages
are counted first, and only those that reach into that tail are split into
words, so no step has to hold a whole user-week's text.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from followrec.functions import (
    clean_text,
    days_since,
    first_link_description,
    iso_z_to_date,
    tokens,
    week_bin,
    week_bounds,
)
from followrec.operators.prefix import grouped_exclusive_sum
from followrec.params import Params
from followrec.session import scratch_path
from followrec.sources.sinks import cut_lineage, path_exists

WEEK_KEY = ["user_id", "week_idx"]


# ---------------------------------------------------------------- messages
def message_frame(messages: DataFrame, params: Params) -> DataFrame:
    """Message level: calendar date, day offset, week bin, first link text."""
    created = iso_z_to_date("created_at")
    day = days_since(created, params.anchor_date)
    return messages.select(
        "user_id", "msg_id",
        "created_at",
        created.alias("created_date"),
        day.alias("day"),
        week_bin(day, params.bin_days, params.max_day).alias("week_idx"),
        "body",
        first_link_description("links").alias("link_desc"),
        "recommended")


def with_week_bounds(df: DataFrame, params: Params) -> DataFrame:
    start, end = week_bounds("week_idx", params.anchor_date, params.bin_days)
    return df.withColumn("week_start", start).withColumn("week_end", end)


def clean_messages(msgs: DataFrame) -> DataFrame:
    return (msgs.withColumn("clean_body", clean_text("body"))
            .withColumn("clean_link_desc", clean_text("link_desc")))


def binned(msgs: DataFrame) -> DataFrame:
    """Messages inside a week bin (day <= 0 or past the last bin fall out)."""
    return msgs.filter(F.col("week_idx").isNotNull())


def weekly_text(clean: DataFrame, params: Params) -> DataFrame:
    """Cleaned body and link texts of a user-week, blank-joined in message order.

    Order key is (creation time, message id). One row per user-week, whatever
    its size: the text is one value by definition. Nothing downstream needs
    it; the model input is built from messages (see `padded_tails`).
    """
    m = F.sort_array(F.collect_list(F.struct(
        "created_at", "msg_id", "clean_body", "clean_link_desc")))
    out = (binned(clean).groupBy(*WEEK_KEY)
           .agg(m.alias("m"), F.count(F.lit(1)).alias("n_messages"))
           .select(*WEEK_KEY, "n_messages",
                   F.array_join(F.transform("m", lambda x: x["clean_body"]), " ")
                   .alias("clean_body"),
                   F.array_join(F.transform("m", lambda x: x["clean_link_desc"]), " ")
                   .alias("clean_link_desc")))
    return with_week_bounds(out, params)


def user_weeks(msgs: DataFrame) -> DataFrame:
    """Observed user-weeks with their label counts."""
    return (binned(msgs).groupBy(*WEEK_KEY)
            .agg(F.count(F.lit(1)).alias("n_messages"),
                 F.count("recommended").alias("n_labelled"),
                 F.avg("recommended").alias("label_share")))


# ---------------------------------------------------------------- scoring
def weekly_class(probs: DataFrame, params: Params) -> DataFrame:
    """1 when probability >= threshold, else 0 (no probability -> 0)."""
    return probs.withColumn(
        "pred_class",
        F.when(F.col("probability") >= F.lit(params.class_threshold), F.lit(1))
        .otherwise(F.lit(0)))


def reputation_score(classes: DataFrame) -> DataFrame:
    """Share of a user's weeks predicted positive: user_id, pred."""
    return (classes.groupBy("user_id")
            .agg(F.avg(F.col("pred_class").cast("double")).alias("pred")))


# ---------------------------------------------------------------- text model input
def training_weeks(msgs: DataFrame) -> DataFrame:
    """User-weeks with at least one labelled message, labelled 1 when the
    share of recommended messages is at least one half."""
    return (user_weeks(msgs).filter(F.col("n_labelled") > 0)
            .select(*WEEK_KEY,
                    F.when(F.col("label_share") >= 0.5, 1.0).otherwise(0.0).alias("label")))


def keyed_messages(clean: DataFrame) -> DataFrame:
    """Words of the binned messages, split and written once to the shared folder.

    `msg_key` names the message row (`msg_id` may be absent or repeated); it is
    part of the written rows, so every reader sees the same names. A frame that
    was written so already is returned as it is.
    """
    if "msg_key" in clean.columns:
        return clean
    spark = clean.sparkSession
    cols = binned(clean).select(*WEEK_KEY, "created_at", "msg_id", "recommended",
                                F.monotonically_increasing_id().alias("msg_key"),
                                tokens("clean_body").alias("words"))
    return cut_lineage(spark, cols, scratch_path(spark, "clean-text"))


def message_tokens(keyed: DataFrame) -> DataFrame:
    """One row per word of a message: position within its message."""
    return keyed.select(*WEEK_KEY, "created_at", "msg_id", "msg_key",
                        F.posexplode("words").alias("pos", "token"))


def known_tokens(keyed: DataFrame, vocab: DataFrame) -> DataFrame:
    """Words of the vocabulary only (at most vocab_size rows, broadcast)."""
    return message_tokens(keyed).join(
        F.broadcast(vocab.select("token", "token_index")), "token").drop("token")


def message_offsets(keyed: DataFrame, vocab: DataFrame) -> DataFrame:
    """Per message with known words: how many (`n_known`), how many come before
    in its week (`offset`) and in the whole week (`week_total`).

    Words are counted map-side (a message lies in one task); only one row of
    numbers per message goes through the running sum of the weeks, which stays
    balanced when one user-week holds a large share of all messages.
    """
    counts = (known_tokens(keyed, vocab).groupBy(*WEEK_KEY, "created_at", "msg_id", "msg_key")
              .agg(F.count(F.lit(1)).alias("n_known")))
    return grouped_exclusive_sum(counts, WEEK_KEY, ["created_at", "msg_id", "msg_key"],
                                 "n_known", "offset", "week_total")


def token_vocabulary(clean: DataFrame, params: Params) -> DataFrame:
    """Word index fitted on the training weeks' text.

    Index 1 is the most frequent word; ties go to the smaller word. Only
    indexes below vocab_size are kept, i.e. a top-(vocab_size - 1) report:
    each partition keeps its own top rows before the final merge, and the
    result (bounded by vocab_size) is what later steps broadcast.
    """
    clean = keyed_messages(clean)
    weeks = training_weeks(clean).select(*WEEK_KEY)
    weeks = cut_lineage(clean.sparkSession, weeks, scratch_path(clean.sparkSession, "weeks"))
    # both sides are plain shuffles, which AQE splits at a hot user-week
    train = clean.join(weeks, WEEK_KEY, "left_semi")
    counts = (train.select(F.explode("words").alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    top = counts.orderBy(F.col("n").desc(), F.col("token").asc()).limit(params.vocab_size - 1)
    w = Window.orderBy(F.col("n").desc(), F.col("token").asc())
    return top.withColumn("token_index", F.row_number().over(w))


def encode_sequences(clean: DataFrame, vocab: DataFrame) -> DataFrame:
    """Known words of each user-week as index sequence, long form.

    Output: user_id, week_idx, seq_pos (0-based over the week's concatenated
    text), token_index, week_total (known words in the week). Unknown words
    are dropped.
    """
    keyed = keyed_messages(clean)
    known = known_tokens(keyed, vocab)
    in_message = Window.partitionBy("msg_key").orderBy("pos")
    known = known.withColumn("k", F.row_number().over(in_message) - 1)
    placed = message_offsets(keyed, vocab).select("msg_key", "offset", "week_total")
    return (known.join(placed, "msg_key")
            .select(*WEEK_KEY, (F.col("offset") + F.col("k")).cast("long").alias("seq_pos"),
                    "token_index", "week_total"))


def tail_messages(offsets: DataFrame, params: Params) -> DataFrame:
    """Messages that reach into the last seq_len known words of their week.

    `newer` counts the known words after the message; `take` how many of its
    own last words are inside the tail. Per week these messages hold at most
    seq_len words plus the rest of one message.
    """
    newer = F.col("week_total") - F.col("offset") - F.col("n_known")
    return (offsets.withColumn("newer", newer).filter(F.col("newer") < params.seq_len)
            .withColumn("take", F.least("n_known", F.lit(params.seq_len) - F.col("newer"))
                        .cast("int")))


def padded_tails(clean: DataFrame, vocab: DataFrame, weeks: DataFrame,
                 params: Params) -> DataFrame:
    """Last seq_len indexes of each user-week, zeros in front.

    First only numbers: known words per message and their running sums. Then
    only the messages of the tail are split into words again, and each gives
    its last `take` indexes. Weeks with no known word get all zeros.
    Output: user_id, week_idx, n_tokens, sequence.
    """
    n = params.seq_len
    keyed = keyed_messages(clean)
    tail = cut_lineage(keyed.sparkSession,
                       tail_messages(message_offsets(keyed, vocab), params),
                       scratch_path(keyed.sparkSession, "tail-messages"))
    chosen = keyed.join(tail.select("msg_key", "newer", "take"), "msg_key")
    words = F.sort_array(F.collect_list(F.struct("pos", "token_index")))
    ends = (chosen.select("msg_key", *WEEK_KEY, "newer", "take",
                          F.posexplode("words").alias("pos", "token"))
            .join(F.broadcast(vocab.select("token", "token_index")), "token")
            .groupBy("msg_key", *WEEK_KEY, "newer", "take").agg(words.alias("w"))
            .select(*WEEK_KEY, "newer", F.slice(
                F.transform("w", lambda x: x["token_index"]), -F.col("take"), F.col("take"))
                .alias("end")))
    # newer differs between the messages of a week: they all have known words
    slots = (ends.groupBy(*WEEK_KEY)
             .agg(F.sort_array(F.collect_list(F.struct("newer", "end")), asc=False).alias("m"))
             .select(*WEEK_KEY, F.flatten(F.transform("m", lambda x: x["end"])).alias("s")))
    totals = tail.groupBy(*WEEK_KEY).agg(F.max("week_total").alias("n_tokens"))
    seq = F.concat(F.array_repeat(F.lit(0), F.lit(n) - F.size("s")), "s")
    return (weeks.select(*WEEK_KEY).join(slots, WEEK_KEY, "left").join(totals, WEEK_KEY, "left")
            .select(*WEEK_KEY,
                    F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long").alias("n_tokens"),
                    F.when(F.col("s").isNull(), F.array_repeat(F.lit(0), n))
                    .otherwise(seq).alias("sequence")))


def model_input(clean: DataFrame, params: Params, vocab: DataFrame | None = None,
                train: DataFrame | None = None):
    """(vocabulary, padded sequences of every observed user-week of `clean`).

    The vocabulary is `vocab` when given, else fitted on the labelled weeks
    of `train` (default: `clean` itself) and written once: counting, encoding
    and padding then read it.
    """
    clean = keyed_messages(clean)
    if vocab is None:
        fitted = token_vocabulary(keyed_messages(train) if train is not None else clean, params)
        vocab = cut_lineage(clean.sparkSession, fitted,
                            scratch_path(clean.sparkSession, "vocabulary"))
    return vocab, padded_tails(clean, vocab, user_weeks(clean), params)


# ---------------------------------------------------------------- scorers
# A scorer maps cleaned messages (and optional cleaned training messages) to
# (user_id, week_idx, probability) for every observed user-week.
Scorer = Callable[..., DataFrame]


def label_share_scorer(spark: SparkSession, clean: DataFrame, params: Params,
                       train: DataFrame | None = None) -> DataFrame:
    """Probability of a user-week = share of its labelled messages marked
    recommended (null when none is labelled). A transparent stand-in model."""
    return user_weeks(clean).select(*WEEK_KEY, F.col("label_share").alias("probability"))


def _terms(padded: DataFrame) -> DataFrame:
    return padded.select(*WEEK_KEY, F.transform(
        F.filter("sequence", lambda x: x > 0), lambda x: x.cast("string")).alias("terms"))


@dataclass
class SparkMLScorer:
    """Bag-of-words logistic regression over the padded model input.

    Features: counts of the word indexes of the padded sequence (the same
    tail of the week the sequence model sees), IDF-weighted. Fitted on the
    labelled weeks of the training messages (default: the scored messages),
    applied to all weeks. With `model_path`, a model saved there earlier
    (pipeline + vocabulary) is loaded and only scoring runs; otherwise the
    fitted model is saved there (or to the checkpoint folder).
    """

    max_iter: int = 50
    reg_param: float = 0.01
    model_path: str | None = None

    def fit(self, spark: SparkSession, train: DataFrame, params: Params, path: str) -> str:
        """Fit vocabulary + pipeline on cleaned training messages; save to `path`."""
        self._fit(spark, train, params, path)
        return path

    def _fit(self, spark: SparkSession, train: DataFrame, params: Params,
             path: str) -> DataFrame:
        """`fit`; returns the model input of all weeks of `train`, written once."""
        from pyspark.ml import Pipeline
        from pyspark.ml.classification import LogisticRegression
        from pyspark.ml.feature import IDF, CountVectorizerModel

        train = keyed_messages(train)
        vocab, padded = model_input(train, params)
        # Fitting passes over the data several times (IDF, then the optimizer):
        # materialize the model input once in the shared checkpoint folder.
        terms = cut_lineage(spark, _terms(padded), scratch_path(spark, "model-input"))
        data = cut_lineage(spark, terms.join(training_weeks(train), WEEK_KEY),
                           scratch_path(spark, "training-input"))
        # The term space is the index range itself, fixed by vocab_size.
        cv = CountVectorizerModel.from_vocabulary(
            [str(i) for i in range(1, params.vocab_size)], inputCol="terms", outputCol="tf")
        pipe = Pipeline(stages=[
            cv, IDF(inputCol="tf", outputCol="features"),
            LogisticRegression(featuresCol="features", labelCol="label",
                               maxIter=self.max_iter, regParam=self.reg_param)])
        pipe.fit(data).write().overwrite().save(f"{path}/pipeline")
        vocab.select("token", "n", "token_index").write.mode("overwrite").parquet(
            f"{path}/vocabulary")
        return terms

    def __call__(self, spark: SparkSession, clean: DataFrame, params: Params,
                 train: DataFrame | None = None) -> DataFrame:
        from pyspark.ml import PipelineModel
        from pyspark.ml.functions import vector_to_array

        path, terms = self.model_path, None
        clean = keyed_messages(clean)
        if path is None or not path_exists(spark, f"{path}/pipeline"):
            path = path or scratch_path(spark, "text-model")
            if train is None:  # the weeks to score are those fitted on: one model input
                terms = self._fit(spark, clean, params, path)
            else:
                self.fit(spark, train, params, path)
        # Scoring always uses the persisted model (a freshly fitted one also
        # carries its training summary, which holds a reference to the session).
        model = PipelineModel.load(f"{path}/pipeline")
        if terms is None:
            vocab = spark.read.parquet(f"{path}/vocabulary")
            terms = _terms(model_input(clean, params, vocab=vocab)[1])
        return (model.transform(terms)
                .select(*WEEK_KEY,
                        vector_to_array("probability")[1].alias("probability")))


def _score_batches(padded: DataFrame, model: Callable[[], Callable], batch_size: int) -> DataFrame:
    """Score padded sequences in Arrow batches; `model()` gives the predictor in a worker."""

    def run(batches):
        import numpy as np
        import pandas as pd
        predict = model()
        for pdf in batches:
            for i in range(0, len(pdf), batch_size):
                chunk = pdf.iloc[i:i + batch_size]
                x = np.stack([np.asarray(s, dtype=np.int32) for s in chunk["sequence"]])
                p = np.asarray(predict(x), dtype=np.float64).reshape(-1)
                yield pd.DataFrame({"user_id": chunk["user_id"].to_numpy(),
                                    "week_idx": chunk["week_idx"].to_numpy(),
                                    "probability": p})

    return padded.select(*WEEK_KEY, "sequence").mapInPandas(
        run, "user_id long, week_idx int, probability double")


def batch_model_scorer(predict: Callable, batch_size: int = 1024) -> Scorer:
    """Wrap any batch model `predict(np.ndarray[n, seq_len]) -> probabilities`.

    Runs inside the executors through Arrow batches (mapInPandas); the model is
    called on at most `batch_size` padded sequences at a time. The vocabulary
    is fitted on the training messages (default: the scored messages). `predict`
    travels inside every task: for a large model use `model_file_scorer`.
    """

    def score(spark: SparkSession, clean: DataFrame, params: Params,
              train: DataFrame | None = None) -> DataFrame:
        _, padded = model_input(clean, params, train=train)
        return _score_batches(padded, lambda: predict, batch_size)

    return score


def model_file_scorer(path: str, load: Callable[[str], Callable],
                      batch_size: int = 1024) -> Scorer:
    """Score with a model kept in a file, `load(local_path) -> predict`.

    The file (any path Spark can read) is shipped once to every executor, and
    each Python worker loads it once, however many tasks it runs
    (`workermodel`). Tasks carry the file's name and the loader only.
    """

    def score(spark: SparkSession, clean: DataFrame, params: Params,
              train: DataFrame | None = None) -> DataFrame:
        from followrec.operators import workermodel

        spark.sparkContext.addFile(path)
        name = path.rstrip("/").rsplit("/", 1)[-1]
        _, padded = model_input(clean, params, train=train)
        return _score_batches(padded, lambda: workermodel.loaded(name, load), batch_size)

    return score


# ---------------------------------------------------------------- linear model as a table
def week_counts(padded: DataFrame) -> DataFrame:
    """How often each index stands in a week's padded sequence: user_id, week_idx, i, n."""
    return (padded.select(*WEEK_KEY, F.explode("sequence").alias("i")).filter("i > 0")
            .groupBy(*WEEK_KEY, "i").agg(F.count(F.lit(1)).alias("n")))


def ratio_coefficients(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """Coefficient table of a log-count-ratio model: i, coef. Index 0 is the intercept.

    `counts(user_id, week_idx, i, n)` and `labels(user_id, week_idx, label)`;
    coef = ln((n1 + 1) / (N1 + V)) - ln((n0 + 1) / (N0 + V)) with the word's
    and all words' occurrences in positive and negative weeks and V distinct
    words (multinomial naive Bayes). All of it is one aggregate over the
    training words; the table has at most vocab_size rows.
    """
    def in_class(c):
        return F.coalesce(F.sum(F.when(F.col("label") == c, F.col("n"))), F.lit(0))

    words = (counts.join(labels, WEEK_KEY).groupBy("i")
             .agg(in_class(1).alias("n1"), in_class(0).alias("n0")))
    total = words.agg(F.struct(F.sum("n1").alias("all1"), F.sum("n0").alias("all0"),
                               F.count(F.lit(1)).alias("size"))).scalar()
    coef = (F.log((F.col("n1") + 1) / (total["all1"] + total["size"]))
            - F.log((F.col("n0") + 1) / (total["all0"] + total["size"])))
    prior = labels.agg(F.log((F.count_if(F.col("label") == 1) + 1)
                             / (F.count_if(F.col("label") == 0) + 1)).alias("coef"))
    return (words.select(F.col("i").cast("bigint").alias("i"), coef.alias("coef"))
            .unionByName(prior.select(F.lit(0).cast("bigint").alias("i"), "coef")))


def score_by_table(counts: DataFrame, coefficients: DataFrame, weeks: DataFrame) -> DataFrame:
    """Probability of every week from an exported coefficient table: join and sum.

    The table is bounded by the vocabulary and broadcast; words are summed
    map-side, so neither a long week nor a common word is gathered.
    """
    table = F.broadcast(coefficients.filter("i > 0"))
    sums = (counts.join(table, "i").groupBy(*WEEK_KEY)
            .agg(F.sum(F.col("n") * F.col("coef")).alias("s")))
    start = coefficients.filter("i = 0").select("coef").scalar()
    score = F.coalesce(F.col("s"), F.lit(0.0)) + start
    return (weeks.select(*WEEK_KEY).join(sums, WEEK_KEY, "left")
            .select(*WEEK_KEY, (1 / (1 + F.exp(-score))).alias("probability")))


def area_under_curve(scored: DataFrame) -> DataFrame:
    """Exact area under the ROC curve of `scored(probability, label)`, ties counted half.

    One row: n1, n0, auc (null when a class is missing). Rows are counted per
    distinct probability first; the running number of negatives below then
    comes from the skew-safe running sum, so no task ranks all rows.
    """
    groups = scored.groupBy("probability").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    ranked = grouped_exclusive_sum(groups.withColumn("_all", F.lit(0)), ["_all"], ["probability"],
                                   "neg", "below", "n0")
    wins = F.sum(F.col("pos") * (2 * F.col("below") + F.col("neg")))
    return (ranked.agg(F.sum("pos").alias("n1"), F.sum("neg").alias("n0"), wins.alias("w"))
            .select("n1", "n0", F.expr("try_divide(w, 2.0D * n1 * n0)").alias("auc")))


def reputation_scores(spark: SparkSession, messages: DataFrame, params: Params,
                      scorer: Scorer = label_share_scorer,
                      training_messages: DataFrame | None = None) -> DataFrame:
    """X2: user_id, pred. `training_messages` (labelled) fit the vocabulary and
    model when given; otherwise the labelled weeks of `messages` do."""
    clean = clean_messages(message_frame(messages, params))
    train = None
    if training_messages is not None:
        train = clean_messages(message_frame(training_messages, params))
    probs = scorer(spark, clean, params, train=train)
    return reputation_score(weekly_class(probs, params))
