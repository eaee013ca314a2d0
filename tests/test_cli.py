"""The command-line daily run over files in the at-rest formats."""

from followrec.__main__ import main
from followrec.sources import feeds as fd
from followrec.sources import sinks as sk
from followrec.sources import testdata as td


def test_cli_daily_run(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    feeds_dir = fd.write_feeds_csv(td.map_feeds(spark, sf), str(tmp_path / "20240131"))
    msgs = str(tmp_path / "messages")
    td.map_messages(spark, sf).write.json(msgs)
    publish = str(tmp_path / "published")
    rc = main(["--feeds", feeds_dir, "--messages", msgs, "--as-of", "2024-01-31",
               "--publish", publish, "--outputs", str(tmp_path / "out"), "--label-share"])
    assert rc == 0
    recs = spark.read.parquet(sk.latest_manifest(spark, publish).tables["recommendations"])
    assert recs.count() == 68          # golden count, sf0.001, 90 days
