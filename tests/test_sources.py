"""Message JSON scan, daily partitions, sizing helper."""

from datetime import datetime

import pytest

from followrec.session import cluster_conf
from followrec.sources import feeds as fd


def test_messages_json(spark, tmp_path):
    p = tmp_path / "msgs"
    p.mkdir()
    (p / "a.json").write_text(
        '{"user_id": 1, "msg_id": 10, "body": "hi", "created_at": "2018-09-10T01:02:03Z",'
        ' "recommended": 1, "links": [{"description": "d"}]}\n'
        '{"user_id": 2, "msg_id": 11, "body": "yo", "created_at": "2018-09-11T01:02:03Z"}\n')
    rows = {r.msg_id: r for r in fd.read_messages(spark, str(p)).collect()}
    assert rows[10].recommended == 1 and rows[10].links[0].description == "d"
    assert rows[11].recommended is None and rows[11].links is None   # scoring rows
    (p / "b.json").write_text('{"user_id": 3, "msg_id": \n')
    with pytest.raises(Exception):
        fd.read_messages(spark, str(p)).collect()
    q = tmp_path / "nobody"
    q.mkdir()
    (q / "a.json").write_text('{"user_id": 4, "created_at": "2018-09-10T01:02:03Z"}\n')
    with pytest.raises(Exception, match="null body"):
        fd.read_messages(spark, str(q)).collect()


def test_daily_partition_read(spark, tmp_path):
    from conftest import ENG
    df = spark.createDataFrame(
        [(1, 2, 1, datetime(2024, 1, 30, 5), "reply"),
         (1, 3, 2, datetime(2024, 1, 29, 5), "reply")], ENG)
    root = fd.write_daily_partitioned(df, str(tmp_path / "reply"))
    got = fd.read_daily_partition(spark, root, datetime(2024, 1, 30)).collect()
    assert [(r.engaged_with_user_id, str(r.ds)) for r in got] == [(2, "20240130")]
    assert fd.daily_folder("s3://b/graph_data", datetime(2024, 1, 30)) == \
        "s3://b/graph_data/20240130"


def test_cluster_conf_bounds():
    big = cluster_conf(100 * 10**12, 8, 1000)
    assert big["spark.sql.shuffle.partitions"] == "50000"
    small = cluster_conf(10**9, 4, 2)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert small["spark.sql.adaptive.enabled"] == "true"


def test_numbers_in_csv(spark, tmp_path):
    p = tmp_path / "user.csv"
    p.write_text("".join(f"{i},{',' * 9},{v}\n" for i, v in
                         enumerate(["1", "1.0", "0", "", " 1 ", "nan"])))
    got = {r.user_id: r.suspended for r in fd.read_user(spark, str(p)).collect()}
    assert got == {0: 1, 1: 1, 2: 0, 3: None, 4: 1, 5: None}
    p = tmp_path / "bad.csv"
    p.write_text(f"7,{',' * 9},true\n")
    with pytest.raises(Exception, match="unreadable suspended"):
        fd.read_user(spark, str(p)).collect()
    p = tmp_path / "score.csv"
    p.write_text("user_id,pred\n1,0.5\n2,\n")
    assert [tuple(r) for r in fd.read_scores(spark, str(p)).collect()] == [(1, 0.5), (2, None)]
    p.write_text("user_id,pred\n1,abc\n")
    with pytest.raises(Exception, match="unreadable pred"):
        fd.read_scores(spark, str(p)).collect()


def test_closest_lists_must_agree(spark):
    ddl = "user_id long, engaged_with_user_id string, weight string"
    good = spark.createDataFrame([(1, "2,3", "0.50000000,0.25000000"), (2, None, None)], ddl)
    rows = fd.parse_closest_lists(good).collect()
    assert [(r.engaged_with_user_id, r["rank"], r.w8) for r in rows] == [
        (2, 1, 50_000_000), (3, 2, 25_000_000)]
    for ids, weights in (("2,3,4", "0.5,0.25"), ("2", None)):
        bad = spark.createDataFrame([(1, ids, weights)], ddl)
        with pytest.raises(Exception, match="unequal length"):
            fd.parse_closest_lists(bad).collect()
