"""Independent SQL (DuckDB dialect) for every registered query.

Written from the semantics, not from the Spark code: plain joins, NOT EXISTS,
window functions and string_agg over the raw test tables (events, documents,
labels). Column names and types match the Spark results.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from followrec.params import Params

P = Params()
SCALE = 100_000_000

# Fixed values of the stand-in input mapping (FIXTURES.md section 2).
CLEAN_SQL = (
    "lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
    "{x}, '@[\\p{{L}}\\p{{N}}_]+', '', 'g'), 'https?://[^\\s\\p{{Z}}]+', 'http', 'g'), "
    "'[[:punct:]]', '', 'g'), '[^\\x00-\\x7F]', '', 'g'), '\\d+', '', 'g'))"
)


def _ts(dt: datetime) -> str:
    return f"TIMESTAMP '{dt:%Y-%m-%d %H:%M:%S}'"


def w8_sql(x: str, L: int) -> str:
    return f"(({x} // {L}) * {SCALE} + (({x} % {L}) * {SCALE} + {L // 2}) // {L})"


def dec_sql(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,0)) * CAST(0.00000001 AS DECIMAL(9,8)) AS DECIMAL(18,8))"


BASE = """
ev AS (SELECT event_id, ts, user_id, event_type,
              CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
follow AS (SELECT user_id, k AS engaged_with_user_id, ts FROM ev WHERE event_type = 'signup'),
users AS (SELECT id AS user_id,
                 CASE WHEN id % 17 = 0 THEN 1 WHEN id % 17 = 1 THEN NULL ELSE 0 END AS suspended
          FROM (SELECT user_id AS id FROM ev UNION SELECT k FROM ev)),
susp AS (SELECT DISTINCT user_id FROM users WHERE suspended = 1)"""


def closest_ctes(p: Params, s: str = "") -> str:
    L = p.lookback_seconds
    return f""",
eng{s} AS (
  SELECT user_id, k AS engaged_with_user_id, ts, 'reply' AS source FROM ev WHERE event_type = 'view'
  UNION ALL SELECT user_id, k, ts, 'mention' FROM ev WHERE event_type = 'purchase'
  UNION ALL SELECT user_id, k, ts, 'like' FROM ev WHERE event_type = 'click'
  UNION ALL SELECT user_id, engaged_with_user_id, ts, 'follow' FROM follow
            WHERE CAST(ts AS DATE) >= DATE '{p.recent_since:%Y-%m-%d}'),
valid{s} AS (SELECT e.* FROM eng{s} e
             WHERE NOT EXISTS (SELECT 1 FROM susp x WHERE x.user_id = e.engaged_with_user_id)),
wtd{s} AS (SELECT user_id, engaged_with_user_id, ts, source,
                  {L} - ({p.as_of_epoch} - epoch_us(ts) // 1000000) AS rem FROM valid{s}),
pairs{s} AS (SELECT user_id, engaged_with_user_id, CAST(SUM(rem) AS BIGINT) AS sum_rem,
                    COUNT(*) AS n_engagements
             FROM wtd{s} WHERE rem > 0 GROUP BY user_id, engaged_with_user_id),
ranked{s} AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
                ORDER BY sum_rem DESC, CAST(engaged_with_user_id AS VARCHAR)) AS rank FROM pairs{s}),
closest{s} AS (SELECT user_id, engaged_with_user_id, CAST(rank AS INTEGER) AS rank, sum_rem,
                      CAST({w8_sql('sum_rem', L)} AS BIGINT) AS w8
               FROM ranked{s} WHERE rank <= {p.n_closest})"""


def rec_ctes(p: Params, s: str = "") -> str:
    return f""",
active{s} AS (SELECT c.* FROM closest{s} c
              WHERE NOT EXISTS (SELECT 1 FROM susp x WHERE x.user_id = c.user_id)),
paths{s} AS (SELECT a.user_id, a.engaged_with_user_id AS reason_id, a.rank AS reason_rank,
                    b.engaged_with_user_id AS rec_id, b.w8
             FROM active{s} a JOIN active{s} b ON b.user_id = a.engaged_with_user_id),
kept{s} AS (SELECT q.* FROM paths{s} q WHERE q.rec_id <> q.user_id
            AND NOT EXISTS (SELECT 1 FROM follow f
                            WHERE f.user_id = q.user_id AND f.engaged_with_user_id = q.rec_id)),
cand{s} AS (SELECT user_id, rec_id, CAST(SUM(w8) AS BIGINT) AS sum_w8, COUNT(*) AS n_reasons
            FROM kept{s} GROUP BY user_id, rec_id),
topr{s} AS (SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY user_id
               ORDER BY sum_w8 DESC, CAST(rec_id AS VARCHAR)) AS INTEGER) AS rank FROM cand{s})
            WHERE rank <= {p.n_rec}),
topreasons{s} AS (SELECT k.user_id, k.rec_id, k.reason_id, {dec_sql('k.w8')} AS weight
                  FROM kept{s} k JOIN topr{s} t ON t.user_id = k.user_id AND t.rec_id = k.rec_id),
finalr{s} AS (SELECT t.* FROM topr{s} t
              WHERE EXISTS (SELECT 1 FROM score h WHERE h.user_id = t.rec_id AND h.pred > {p.min_score})),
finalreasons{s} AS (SELECT r.* FROM topreasons{s} r
              WHERE EXISTS (SELECT 1 FROM score h WHERE h.user_id = r.rec_id AND h.pred > {p.min_score}))"""


def msg_ctes(p: Params = P) -> str:
    a = f"DATE '{p.anchor_date:%Y-%m-%d}'"
    return f""",
msg AS (SELECT d.doc_id % 100 AS user_id, d.doc_id AS msg_id,
               CAST({a} + CAST(d.doc_id % 400 AS INTEGER) AS DATE) AS created_date,
               CASE WHEN d.doc_id % 5 = 0
                    THEN d.text || ' https://example.org/' || CAST(d.doc_id AS VARCHAR)
                    ELSE d.text END AS body,
               CASE WHEN d.doc_id % 3 = 2 THEN COALESCE(d.source, '') ELSE '' END AS link_desc,
               CAST(l.quality AS INTEGER) AS recommended
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
msgd AS (SELECT *, CAST(date_diff('day', {a}, created_date) AS INTEGER) AS day FROM msg),
msgb AS (SELECT *, CASE WHEN day BETWEEN 1 AND {p.max_day}
                        THEN CAST((day - 1) // {p.bin_days} AS INTEGER) END AS week_idx FROM msgd),
msgc AS (SELECT *, {CLEAN_SQL.format(x='body')} AS clean_body,
                   {CLEAN_SQL.format(x='link_desc')} AS clean_link_desc FROM msgb),
uw AS (SELECT user_id, week_idx, COUNT(*) AS n_messages, COUNT(recommended) AS n_labelled,
              AVG(recommended) AS label_share
       FROM msgb WHERE week_idx IS NOT NULL GROUP BY user_id, week_idx),
cls AS (SELECT user_id, week_idx, label_share AS probability,
               CASE WHEN label_share >= {p.class_threshold} THEN 1 ELSE 0 END AS pred_class FROM uw),
score AS (SELECT user_id, AVG(CAST(pred_class AS DOUBLE)) AS pred FROM cls GROUP BY user_id)"""


def text_model_ctes(p: Params = P) -> str:
    return f""",
tw AS (SELECT user_id, week_idx FROM uw WHERE n_labelled > 0),
mt AS (SELECT user_id, week_idx, created_date, msg_id,
              generate_subscripts(toks, 1) - 1 AS pos, unnest(toks) AS token
       FROM (SELECT *, list_filter(string_split_regex(clean_body, '[ \\t\\n]+'),
                                   lambda x: x <> '') AS toks
             FROM msgc WHERE week_idx IS NOT NULL)),
cnt AS (SELECT token, COUNT(*) AS n FROM mt JOIN tw USING (user_id, week_idx) GROUP BY token),
vocab AS (SELECT token, n, ROW_NUMBER() OVER (ORDER BY n DESC, token) AS token_index FROM cnt
          QUALIFY token_index < {p.vocab_size}),
known AS (SELECT mt.*, v.token_index FROM mt JOIN vocab v USING (token)),
enc AS (SELECT user_id, week_idx,
               ROW_NUMBER() OVER (PARTITION BY user_id, week_idx
                                  ORDER BY created_date, msg_id, pos) - 1 AS seq_pos,
               token_index,
               COUNT(*) OVER (PARTITION BY user_id, week_idx) AS week_total
        FROM known),
padded AS (SELECT uw.user_id, uw.week_idx, COALESCE(t.n_tokens, 0) AS n_tokens,
                  array_to_string(list_concat(
                      list_transform(range({p.seq_len} - COALESCE(len(t.l), 0)), lambda x: 0),
                      COALESCE(t.l, []::BIGINT[])), ',') AS sequence
           FROM uw LEFT JOIN (SELECT user_id, week_idx, MAX(week_total) AS n_tokens,
                                     list(token_index ORDER BY seq_pos) AS l
                              FROM enc WHERE seq_pos >= week_total - {p.seq_len}
                              GROUP BY user_id, week_idx) t USING (user_id, week_idx))"""


def _with(*parts: str) -> str:
    return "WITH " + "".join(parts).lstrip().lstrip(",") + "\n"


def lists_sql(src: str) -> str:
    return f"""SELECT user_id,
  string_agg(CAST(engaged_with_user_id AS VARCHAR), ',' ORDER BY rank) AS engaged_with_user_id,
  string_agg(CAST({dec_sql('w8')} AS VARCHAR), ',' ORDER BY rank) AS weight
FROM {src} GROUP BY user_id"""


# ---------------------------------------------------------------- publishing
def batch_selects(s: str) -> dict:
    return {
        "closest_connections": (
            f"SELECT user_id, engaged_with_user_id AS closest_connection, {dec_sql('w8')} AS weight "
            f"FROM closest{s}"),
        "recommendations": f"SELECT user_id, rec_id, 'user' AS type FROM finalr{s}",
        "rec_reasons": (f"SELECT user_id, rec_id, reason_id, 'user' AS type, weight "
                        f"FROM finalreasons{s}"),
    }


TABLE_KEYS = {
    "closest_connections": (["user_id", "closest_connection"], ["weight"]),
    "recommendations": (["user_id", "rec_id", "type"], []),
    "rec_reasons": (["user_id", "rec_id", "reason_id", "type"], ["weight"]),
}


def publish_ctes(p: Params = P) -> str:
    """Yesterday's table (+ 3-day-old leftovers) upserted with today's batch."""
    y, o = p.shifted(-1), p.shifted(-3)
    parts = [closest_ctes(p), closest_ctes(y, "_y"), closest_ctes(o, "_o"),
             rec_ctes(p), rec_ctes(y, "_y"), rec_ctes(o, "_o")]
    now, ts_y, ts_o = _ts(p.as_of), _ts(y.as_of), _ts(o.as_of)
    cutoff = _ts(p.expiry_cutoff)
    for name, (keys, vals) in TABLE_KEYS.items():
        b, by, bo = batch_selects(""), batch_selects("_y"), batch_selects("_o")
        cols = keys + vals
        on = " AND ".join(f"z.{k} = y.{k}" for k in keys)
        tcols = ", ".join(cols)
        parts.append(f""",
{name}_target AS (
  SELECT {tcols}, {ts_y} AS created_at, {ts_y} AS updated_at FROM ({by[name]}) y
  UNION ALL
  SELECT {tcols}, {ts_o} AS created_at, {ts_o} AS updated_at FROM ({bo[name]}) z
  WHERE NOT EXISTS (SELECT 1 FROM ({by[name]}) y WHERE {on})),
{name}_batch AS ({b[name]}),
{name}_merged AS (
  SELECT {", ".join(f"COALESCE(t.{k}, b.{k}) AS {k}" for k in keys)}
         {"".join(f", CASE WHEN b.{keys[0]} IS NOT NULL THEN b.{v} ELSE t.{v} END AS {v}" for v in vals)},
         COALESCE(t.created_at, {now}) AS created_at,
         CASE WHEN b.{keys[0]} IS NOT NULL THEN {now} ELSE t.updated_at END AS updated_at
  FROM {name}_target t FULL OUTER JOIN {name}_batch b
    ON {" AND ".join(f"t.{k} = b.{k}" for k in keys)}),
{name}_pub AS (SELECT * FROM {name}_merged WHERE NOT COALESCE(updated_at < {cutoff}, FALSE))""")
    return "".join(parts)


def dq_union(kind: str, p: Params = P) -> str:
    cutoff = _ts(p.expiry_cutoff)
    out = []
    for name, (keys, _) in TABLE_KEYS.items():
        if kind == "null_keys":
            cond = " OR ".join(f"{k} IS NULL" for k in keys)
            out.append(f"SELECT '{name}' AS table_name, COUNT(*) AS n FROM {name}_pub WHERE {cond}")
        elif kind == "stale_rows":
            out.append(f"SELECT '{name}' AS table_name, COUNT(*) AS n FROM {name}_pub "
                       f"WHERE updated_at < {cutoff}")
        else:
            ks = ", ".join(keys)
            out.append(f"SELECT '{name}' AS table_name, COUNT(*) AS n FROM "
                       f"(SELECT {ks} FROM {name}_pub GROUP BY {ks} HAVING COUNT(*) > 1)")
    return "\nUNION ALL\n".join(out)


def oracle_sql() -> dict[str, str]:
    p, L = P, P.lookback_seconds
    p20 = P.with_(lookback_days=20)
    pk10 = P.with_(n_closest=10)
    base = _with(BASE)
    cl = _with(BASE, closest_ctes(p))
    cl20 = _with(BASE, closest_ctes(p20))
    full = _with(BASE, closest_ctes(p), msg_ctes(), rec_ctes(p))
    full20 = _with(BASE, closest_ctes(p20), msg_ctes(), rec_ctes(p20))
    msgs = _with(BASE, msg_ctes())
    tm = _with(BASE, msg_ctes(), text_model_ctes())
    pub = _with(BASE, msg_ctes(), publish_ctes(P.with_(lookback_days=20)))
    day = p.as_of - timedelta(days=1)
    q = {}

    # scans and sources
    q["scan_follow"] = base + (
        "SELECT user_id, engaged_with_user_id, date_trunc('second', ts) AS ts, "
        "CAST(NULL AS VARCHAR) AS rel_type FROM follow")
    q["scan_engagement"] = base + (
        "SELECT user_id, k AS engaged_with_user_id, event_id AS message_id, "
        "date_trunc('second', ts) AS ts, event_type AS rel_type FROM ev "
        "WHERE event_type IN ('view', 'purchase', 'click')")
    q["scan_user"] = base + "SELECT user_id, CAST(suspended AS INTEGER) AS suspended FROM users"
    q["scan_scores"] = msgs + "SELECT user_id, pred FROM score"
    q["scan_messages"] = msgs + (
        "SELECT user_id, msg_id, body, strftime(created_date, '%Y-%m-%dT%H:%M:%SZ') AS created_at, "
        "recommended FROM msg")
    q["scan_daily_partition"] = base + (
        f"SELECT user_id, k AS engaged_with_user_id, event_id AS message_id, ts, "
        f"event_type AS rel_type, '{day:%Y%m%d}' AS ds FROM ev WHERE event_type = 'view' "
        f"AND CAST(ts AS DATE) = DATE '{day:%Y-%m-%d}'")
    q["preview_feed"] = base + """SELECT feed, user_id, engaged_with_user_id, ts FROM (
  SELECT CASE event_type WHEN 'signup' THEN 'follow' WHEN 'view' THEN 'reply'
              WHEN 'purchase' THEN 'mention' ELSE 'like' END AS feed,
         user_id, k AS engaged_with_user_id, ts
  FROM ev WHERE event_type IN ('signup', 'view', 'purchase', 'click'))
QUALIFY ROW_NUMBER() OVER (PARTITION BY feed ORDER BY user_id, engaged_with_user_id, ts) <= 3"""
    q["parse_closest_lists"] = cl + (
        f"SELECT user_id, engaged_with_user_id, rank, w8, {dec_sql('w8')} AS weight FROM closest")
    q["explode_closest"] = q["parse_closest_lists"]
    q["roundtrip_csv"] = cl + lists_sql("closest")
    q["load_staging"] = cl + (
        f"SELECT user_id, engaged_with_user_id AS closest_connection, {dec_sql('w8')} AS weight "
        "FROM closest")

    # step 1
    q["parse_timestamp"] = base + (
        "SELECT event_id AS message_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts_text, "
        "date_trunc('second', ts) AS ts, epoch_us(ts) // 1000000 AS epoch "
        "FROM ev WHERE event_type = 'view'")
    q["recent_follows"] = base + (
        "SELECT user_id, engaged_with_user_id, ts FROM follow "
        f"WHERE CAST(ts AS DATE) >= DATE '{p20.recent_since:%Y-%m-%d}'")
    q["union_engagements"] = cl + "SELECT user_id, engaged_with_user_id, ts, source FROM eng"
    q["suspended_users"] = base + "SELECT user_id FROM susp"
    q["drop_suspended_targets"] = cl + "SELECT user_id, engaged_with_user_id, ts, source FROM valid"
    q["decay_weight"] = cl + (
        f"SELECT user_id, engaged_with_user_id, ts, source, rem, "
        f"CAST(rem AS DOUBLE) / {float(L)} AS weight FROM wtd WHERE rem > 0")
    q["engagement_strength"] = cl + (
        f"SELECT user_id, engaged_with_user_id, sum_rem, n_engagements, "
        f"CAST({w8_sql('sum_rem', L)} AS BIGINT) AS w8 FROM pairs")
    top_cols = f"SELECT user_id, engaged_with_user_id, rank, sum_rem, w8, {dec_sql('w8')} AS weight FROM closest"
    q["top_closest"] = cl + top_cols
    q["top_closest_k10"] = _with(BASE, closest_ctes(pk10)) + top_cols
    q["closest_lists"] = cl + lists_sql("closest")
    pub_cols = (f"SELECT user_id, engaged_with_user_id AS closest_connection, "
                f"{dec_sql('w8')} AS weight FROM closest")
    q["closest_connections"] = cl + pub_cols
    q["closest_connections_20d"] = cl20 + pub_cols
    q["closest_incremental"] = cl + pub_cols

    # step 3
    q["active_sources"] = full + "SELECT user_id, engaged_with_user_id, rank, w8 FROM active"
    q["second_degree_join"] = full + "SELECT user_id, reason_id, reason_rank, rec_id, w8 FROM paths"
    q["exclude_followed_self"] = full + "SELECT user_id, reason_id, reason_rank, rec_id, w8 FROM kept"
    q["second_degree_agg"] = full + (
        f"SELECT user_id, rec_id, sum_w8, n_reasons, {dec_sql('sum_w8')} AS weight FROM cand")
    q["second_degree_lists"] = full + (
        "SELECT user_id, rec_id, "
        "string_agg(CAST(reason_id AS VARCHAR), ',' ORDER BY reason_rank) AS reasons, "
        f"string_agg(CAST({dec_sql('w8')} AS VARCHAR), ',' ORDER BY reason_rank) AS weights "
        "FROM kept GROUP BY user_id, rec_id")
    q["top_recommendations"] = full + (
        f"SELECT user_id, rec_id, rank, sum_w8, {dec_sql('sum_w8')} AS weight FROM topr")
    q["rec_reasons"] = full + "SELECT user_id, rec_id, reason_id, weight FROM topreasons"
    q["reason_counts"] = full + "SELECT user_id, rec_id, n_reasons FROM topr"
    q["high_scores"] = msgs + f"SELECT user_id, pred FROM score WHERE pred > {p.min_score}"
    fin = f"SELECT user_id, rec_id, rank, {dec_sql('sum_w8')} AS weight FROM finalr"
    q["final_recommendations"] = full + fin
    q["final_recommendations_20d"] = full20 + fin
    q["final_reasons"] = full + "SELECT user_id, rec_id, reason_id, weight FROM finalreasons"
    q["final_reasons_20d"] = full20 + "SELECT user_id, rec_id, reason_id, weight FROM finalreasons"

    # step 2
    q["week_bins"] = msgs + (
        "SELECT user_id, msg_id, created_date, day, week_idx, "
        f"CAST(DATE '{p.anchor_date:%Y-%m-%d}' + (week_idx * {p.bin_days} + 1) AS DATE) AS week_start, "
        f"CAST(DATE '{p.anchor_date:%Y-%m-%d}' + (week_idx * {p.bin_days} + {p.bin_days}) AS DATE) "
        "AS week_end FROM msgb")
    q["link_description"] = msgs + "SELECT user_id, msg_id, link_desc FROM msgb"
    q["clean_text"] = msgs + "SELECT msg_id, clean_body, clean_link_desc FROM msgc"
    q["weekly_text"] = msgs + (
        "SELECT user_id, week_idx, COUNT(*) AS n_messages, "
        f"CAST(DATE '{p.anchor_date:%Y-%m-%d}' + (week_idx * {p.bin_days} + 1) AS DATE) AS week_start, "
        f"CAST(DATE '{p.anchor_date:%Y-%m-%d}' + (week_idx * {p.bin_days} + {p.bin_days}) AS DATE) "
        "AS week_end, "
        "string_agg(clean_body, ' ' ORDER BY created_date, msg_id) AS clean_body, "
        "string_agg(clean_link_desc, ' ' ORDER BY created_date, msg_id) AS clean_link_desc "
        "FROM msgc WHERE week_idx IS NOT NULL GROUP BY user_id, week_idx")
    q["weekly_class"] = msgs + "SELECT user_id, week_idx, probability, pred_class FROM cls"
    q["reputation_score"] = msgs + "SELECT user_id, pred FROM score"
    q["token_vocabulary"] = tm + "SELECT token, n, token_index FROM vocab"
    q["encode_sequences"] = tm + (
        "SELECT user_id, week_idx, seq_pos, token_index, week_total FROM enc")
    q["pad_sequences"] = tm + "SELECT user_id, week_idx, n_tokens, sequence FROM padded"
    model_sql = (
        "SELECT user_id, week_idx, ROUND(1 / (1 + EXP(-s / 1000)), 9) AS probability, "
        "CASE WHEN s >= 0 THEN 1 ELSE 0 END AS pred_class FROM ("
        "SELECT user_id, week_idx, CAST(SUM(CASE WHEN i > 0 THEN (37 * i) % 201 - 100 ELSE 0 END) "
        "AS DOUBLE) AS s FROM (SELECT user_id, week_idx, "
        "CAST(UNNEST(string_split(sequence, ',')) AS BIGINT) AS i FROM padded) "
        "GROUP BY user_id, week_idx)")
    q["score_weeks_fixed_model"] = tm + model_sql
    model_scores = (f"SELECT user_id, AVG(CAST(pred_class AS DOUBLE)) AS pred FROM ({model_sql}) "
                    "GROUP BY user_id")
    q["reputation_score_model"] = tm + model_scores

    table_model = tm + f"""
, words AS (SELECT user_id, week_idx, token_index AS i, COUNT(*) AS n FROM enc
            WHERE seq_pos >= week_total - {p.seq_len} GROUP BY ALL),
lab AS (SELECT user_id, week_idx, CASE WHEN label_share >= 0.5 THEN 1 ELSE 0 END AS label
        FROM uw WHERE n_labelled > 0),
cls_words AS (SELECT i, COALESCE(SUM(n) FILTER (WHERE label = 1), 0) AS n1,
                     COALESCE(SUM(n) FILTER (WHERE label = 0), 0) AS n0
              FROM words JOIN lab USING (user_id, week_idx) GROUP BY i),
tot AS (SELECT SUM(n1) AS a1, SUM(n0) AS a0, COUNT(*) AS v FROM cls_words),
coef AS (SELECT i, ln((n1 + 1) / (a1 + v)) - ln((n0 + 1) / (a0 + v)) AS c FROM cls_words, tot),
prior AS (SELECT ln((COUNT(*) FILTER (WHERE label = 1) + 1)
                    / (COUNT(*) FILTER (WHERE label = 0) + 1)) AS c FROM lab),
prob AS (SELECT user_id, week_idx, ROUND(1 / (1 + EXP(-(COALESCE(s, 0) + prior.c))), 9)
                AS probability
         FROM uw LEFT JOIN (SELECT user_id, week_idx, SUM(n * c) AS s FROM words
                            JOIN coef USING (i) GROUP BY ALL) USING (user_id, week_idx), prior)
"""
    q["classify_weeks_table"] = table_model + (
        "SELECT user_id, week_idx, probability, "
        f"CASE WHEN probability >= {p.class_threshold} THEN 1 ELSE 0 END AS pred_class FROM prob")
    q["classifier_auc"] = table_model + (
        "SELECT x.n1, x.n0, ROUND(y.wins / (2.0::DOUBLE * x.n1 * x.n0), 12) AS auc FROM "
        "(SELECT COUNT(*) FILTER (WHERE label = 1) AS n1, COUNT(*) FILTER (WHERE label = 0) AS n0 "
        "FROM lab) x, (SELECT SUM(CASE WHEN a.probability > b.probability THEN 2 "
        "WHEN a.probability = b.probability THEN 1 ELSE 0 END) AS wins "
        "FROM (SELECT probability FROM prob JOIN lab USING (user_id, week_idx) WHERE label = 1) a, "
        "(SELECT probability FROM prob JOIN lab USING (user_id, week_idx) WHERE label = 0) b) y")

    # publishing and checks
    q["upsert_closest"] = pub + (
        "SELECT user_id, closest_connection, weight, created_at, updated_at "
        "FROM closest_connections_merged")
    q["upsert_recommendations"] = pub + (
        "SELECT user_id, rec_id, type, created_at, updated_at FROM recommendations_merged")
    q["upsert_reasons"] = pub + (
        "SELECT user_id, rec_id, reason_id, type, weight, created_at, updated_at "
        "FROM rec_reasons_merged")
    q["retention_delete"] = pub + (
        "SELECT user_id, closest_connection, weight, created_at, updated_at "
        "FROM closest_connections_pub")
    q["dq_null_keys"] = pub + dq_union("null_keys")
    q["dq_freshness"] = pub + dq_union("stale_rows")
    q["dq_unique_keys"] = pub + dq_union("duplicate_keys")
    checks = []
    for kind in ("null_keys", "stale_rows", "duplicate_keys"):
        checks.append(f"SELECT table_name || '.{kind}' AS check_name, n AS actual, "
                      f"CAST(0 AS BIGINT) AS expected, n = 0 AS passed FROM ({dq_union(kind)})")
    q["dq_report"] = pub + "\nUNION ALL\n".join(checks)
    cutoff = _ts(P.expiry_cutoff)
    q["dq_faulty_rows"] = pub + f""",
planted AS (SELECT user_id, CASE WHEN user_id % 7 <> 3 THEN closest_connection END AS closest_connection,
                   CASE WHEN user_id % 5 = 1 THEN {_ts(P.shifted(-3).as_of)} ELSE updated_at END
                   AS updated_at FROM closest_connections_pub),
faulty AS (SELECT * FROM planted UNION ALL SELECT * FROM planted WHERE user_id % 11 = 2)
SELECT 'null_keys' AS check, COUNT(*) AS n FROM faulty
WHERE user_id IS NULL OR closest_connection IS NULL
UNION ALL SELECT 'stale_rows', COUNT(*) FROM faulty WHERE updated_at < {cutoff}
UNION ALL SELECT 'duplicate_keys', COUNT(*) FROM (SELECT user_id, closest_connection FROM faulty
          GROUP BY user_id, closest_connection HAVING COUNT(*) > 1)"""
    q["dq_any_query"] = base + """
SELECT 'some suspended' AS check_name, CAST(COUNT(*) > 0 AS VARCHAR) AS actual, 'True' AS expected,
       COUNT(*) > 0 AS passed FROM users WHERE suspended = 1
UNION ALL SELECT 'share', CAST(CAST(SUM(suspended) * 0.0 AS DECIMAL(38, 1)) AS VARCHAR), '0',
       SUM(suspended) * 0.0 = 0 FROM users
UNION ALL SELECT 'flags', string_agg(DISTINCT suspended, ',' ORDER BY suspended), '0,1',
       string_agg(DISTINCT suspended, ',' ORDER BY suspended) = '0,1' FROM users
UNION ALL SELECT 'rows', CAST(COUNT(*) AS VARCHAR), '3', COUNT(*) = 3 FROM users
          WHERE user_id IS NULL"""
    scored = msg_ctes().replace("score AS (", "score_of_labels AS (")
    q["final_recommendations_model"] = (
        _with(BASE, closest_ctes(p), scored, text_model_ctes(), f""",
score AS ({model_scores})""", rec_ctes(p)) + fin)
    q["stage_counts"] = _with(BASE, closest_ctes(p), msg_ctes(), rec_ctes(p)) + """
SELECT 'engagements' AS stage, COUNT(*) AS n FROM eng
UNION ALL SELECT 'not_suspended_target', COUNT(*) FROM valid
UNION ALL SELECT 'weighted', COUNT(*) FROM wtd WHERE rem > 0
UNION ALL SELECT 'pairs', COUNT(*) FROM pairs
UNION ALL SELECT 'closest', COUNT(*) FROM closest
UNION ALL SELECT 'active_closest', COUNT(*) FROM active
UNION ALL SELECT 'paths', COUNT(*) FROM paths
UNION ALL SELECT 'kept_paths', COUNT(*) FROM kept
UNION ALL SELECT 'candidates', COUNT(*) FROM cand
UNION ALL SELECT 'top_recommendations', COUNT(*) FROM topr
UNION ALL SELECT 'top_reasons', COUNT(*) FROM topreasons
UNION ALL SELECT 'scored_users', COUNT(*) FROM score
UNION ALL SELECT 'final_recommendations', COUNT(*) FROM finalr
UNION ALL SELECT 'final_reasons', COUNT(*) FROM finalreasons"""
    return q
