"""Readers and writers on small files."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from docketry.sources import files, sinks, snapshots
from docketry.sources.scratch import _written, mark, materialise, release, scratch_dir
from docketry.streaming import feeds


def test_newest_snapshot_is_numeric(spark, tmp_path):
    for stamp, value in (("9", 1), ("10", 2)):
        spark.range(1).select(F.lit(value).alias("v")).write.parquet(str(tmp_path / "deep" / f"t_{stamp}.parquet"))
    df = snapshots.read_latest(spark, str(tmp_path), "load", as_of="2024-01-31 00:00:00")
    row = df.first()
    assert (row["v"], row["audit_stamp"], row["audit_source"], row["audit_process"]) == (2, "10", "t_10.parquet", "load")
    assert str(row["audit_created"]) == "2024-01-31 00:00:00"
    assert snapshots.read_latest(spark, str(tmp_path), "load", numeric=False).first()["audit_stamp"] == "9"
    with pytest.raises(FileNotFoundError):
        snapshots.read_latest(spark, str(tmp_path / "deep" / "t_9.parquet"), "load", pattern=r"none_(\d+)")


def test_lookup_with_mark_and_json_cell(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_text('﻿id,doc\na,"{""x"": 1,\n ""y"": 2}"\n', encoding="utf-8")
    row = files.read_lookup(spark, str(path), "id string, doc string", multiline=True).first()
    assert row["id"] == "a" and json.loads(row["doc"]) == {"x": 1, "y": 2}


def test_config_documents_and_recent_text(spark, tmp_path):
    (tmp_path / "c.json").write_text('{\n "env": "test"\n}')
    assert files.read_config(spark, str(tmp_path / "c.json")).first()["env"] == "test"
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.html").write_text("<p>é</p>", encoding="utf-8")
    (tmp_path / "d" / "b.txt").write_text("one\ntwo")
    docs = files.read_documents(spark, str(tmp_path), "*.html").collect()
    assert [(d["file_name"], d["content_str"]) for d in docs] == [("a.html", "<p>é</p>")]
    lines = files.read_recent_text(spark, str(tmp_path / "d" / "b.txt"), F.lit("2000-01-01").cast("timestamp"))
    assert sorted(r["line"] for r in lines.collect()) == ["one", "two"]
    none = files.read_recent_text(spark, str(tmp_path / "d" / "b.txt"), F.lit("2100-01-01").cast("timestamp"))
    assert none.count() == 0


def test_table_or_catalog(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "x.parquet"))
    assert files.table_or_catalog(spark, "x", str(tmp_path)).count() == 2
    spark.range(3).createOrReplaceTempView("x")
    assert files.table_or_catalog(spark, "x", str(tmp_path)).count() == 3
    spark.catalog.dropTempView("x")
    with pytest.raises(ValueError):
        files.table_or_catalog(spark, "nowhere")


def _flaky(key: str, body: str) -> None:
    if key == "2":
        raise BufferError("full")
    if key == "3":
        raise ValueError("bad record")


def test_publish_reports_every_row(spark):
    df = spark.range(1, 4).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("b"))
    rows = {r["file_name"]: r for r in sinks.publish(df, _flaky, "k", "b").collect()}
    assert (rows["1"]["status"], rows["1"]["attempts"]) == ("success", 1)
    assert (rows["2"]["status"], rows["2"]["error_message"], rows["2"]["attempts"]) == ("failed", "full", 3)
    assert (rows["3"]["status"], rows["3"]["attempts"]) == ("failed", 1)
    status = {r["k"]: r["transfer_status"] for r in sinks.upload_documents(df, _flaky, "k", "b").collect()}
    assert status == {"1": "success", "2": "failure: full", "3": "failure: bad record"}


def test_ensure_table_and_append_with_more_columns(spark, tmp_path):
    path = str(tmp_path / "audit")
    assert sinks.ensure_table(spark, path, "run string, n long").count() == 0
    sinks.append(spark.createDataFrame([("a", 1)], "run string, n long"), path)
    sinks.append(spark.createDataFrame([("b", 2, "x")], "run string, n long, status string"), path)
    assert sinks.ensure_table(spark, path, "run string, n long").count() == 2
    rows = sinks.read_appended(spark, path).orderBy("run").collect()
    assert [(r["run"], r["status"]) for r in rows] == [("a", None), ("b", "x")]


def test_drop_clones_keeps_null_keys(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    assert sorted(r["k"] or 0 for r in sinks.drop_clones(df, "k", [2]).collect()) == [0, 1]


def test_scratch_follows_the_cluster_folder(spark):
    class Session:
        class conf:
            @staticmethod
            def get(key, default):
                return "/shared/checkpoints/" if key == "spark.checkpoint.dir" else default

    assert scratch_dir(Session) == "/shared/checkpoints"

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        scratch_dir(Cluster)
    assert scratch_dir(spark) != "/shared/checkpoints"
    stored = materialise(spark.range(3), "t")
    assert stored.count() == 3
    folder = stored.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
    assert release(spark) >= 1 and not os.path.exists(folder)


def test_streams_take_new_files_once(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "operation string, n long"

    def run():
        feeds.route_stream(feeds.stream_json(spark, str(landing), schema), "operation", out, checkpoint)

    (landing / "1.json").write_text('{"operation": "create", "n": 1}\n{"operation": "upload", "n": 2}\n')
    run()
    run()
    (landing / "2.json").write_text('{"operation": "create", "n": 3}\n')
    run()
    rows = spark.read.parquet(out).groupBy("operation").agg(F.sum("n").alias("n")).collect()
    assert {r["operation"]: r["n"] for r in rows} == {"create": 4, "upload": 2}


def test_kafka_values_are_parsed(spark, tmp_path):
    (tmp_path / "m.txt").write_text('{"CaseNo": "A/1", "Status": "SUCCESS"}\nbroken\n')
    raw = spark.readStream.text(str(tmp_path)).select(F.encode("value", "UTF-8").alias("value"))
    out, checkpoint = feeds.scratch_paths(spark, "kafka-test")
    feeds.append_stream(feeds.kafka_json(raw, "CaseNo string, Status string"), out, checkpoint)
    rows = {(r["CaseNo"], r["Status"]) for r in spark.read.parquet(out).collect()}
    assert rows == {("A/1", "SUCCESS"), (None, None)}


def test_dual_sink_repeats_into_the_same_folder(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in" / "t.parquet"))
    current, history = str(tmp_path / "c"), str(tmp_path / "h")
    for run in ("cp1", "cp2"):
        # A lost checkpoint replays the batch; the folders of batch 0 are replaced, not doubled.
        feeds.dual_sink(feeds.stream_table(spark, str(tmp_path / "in"), "t"), current, history, str(tmp_path / run))
    assert spark.read.parquet(current).count() == 5 == spark.read.parquet(history).count()


def test_release_keeps_what_is_named_and_older(spark):
    older = materialise(spark.range(2), "older")
    start = mark()
    kept, gone = (materialise(spark.range(n), "newer") for n in (3, 4))
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    named = [p for p in _written[start:] if path.endswith(p)]
    assert release(spark, since=start, keep=named) == 1
    assert older.count() == 2 and kept.count() == 3
    assert len(_written) == start + 1 and gone.columns == ["id"]


# ---- rescue of bad messages --------------------------------------------------------------------------------


def test_rescued_keeps_what_does_not_fit(spark):
    texts = ['{"a":1,"b":"x"}', '{"a":"one","b":"x"}', '{"a":1', "[1]", "7", "", None, '{"a":2,"c":{"d":[1]},"e":null}', "{}", '{"a":null}']
    raw = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "offset int, value string")
    got = {r["offset"]: r for r in feeds.rescued(raw, "value", "a long, b string").collect()}
    assert (got[0]["a"], got[0]["b"], got[0]["_bad"], got[0]["_unknown"]) == (1, "x", None, None)
    assert (got[1]["a"], got[1]["b"], got[1]["_bad"], got[1]["_reason"]) == (None, None, texts[1], "a field has another type")
    for i in (2, 3, 4, 5):
        assert (got[i]["a"], got[i]["_bad"], got[i]["_reason"]) == (None, texts[i], "no JSON object"), i
    assert (got[6]["_bad"], got[6]["_reason"]) == ("", "no value")
    assert got[7]["a"] == 2 and json.loads(got[7]["_unknown"]) == {"c": '{"d":[1]}', "e": None}
    assert all(got[i]["_bad"] is None and got[i]["_unknown"] is None for i in (8, 9))
    assert sum(r["_reason"] is None for r in got.values()) + sum(r["_reason"] is not None for r in got.values()) == len(texts)


def test_bad_messages_over_a_restart(spark, tmp_path):
    """Rows in are rows read plus rows quarantined, also when one sink has stopped behind the other and runs again."""
    landing, out = tmp_path / "in", tmp_path / "out"
    landing.mkdir()
    (landing / "1.json").write_text('{"a":1}\n{"a":\n\n{"a":2,"z":3}\n')
    stream = lambda: feeds.rescued(feeds.stream_lines(spark, str(landing)), "value", "a long")
    # Only the first sink has run when the job stops.
    feeds.append_stream(stream().filter("_reason IS NULL").drop("_bad", "_reason"), f"{out}/good", f"{out}/cp/good")
    (landing / "2.json").write_text('nonsense\n{"a":4}\n')
    for _ in range(2):
        feeds.split_bad(stream(), f"{out}/good", f"{out}/bad", f"{out}/cp")
    good = spark.read.schema("source_file string, a long, _unknown string").parquet(f"{out}/good").collect()
    bad = spark.read.schema("source_file string, _bad string, _reason string").parquet(f"{out}/bad").collect()
    assert sorted((r["source_file"], r["a"], r["_unknown"]) for r in good) == [("1.json", 1, None), ("1.json", 2, '{"z":"3"}'), ("2.json", 4, None)]
    assert sorted((r["source_file"], r["_bad"]) for r in bad) == [("1.json", '{"a":'), ("2.json", "nonsense")]


# ---- publisher with a window -------------------------------------------------------------------------------


class Broker:
    """Holds ``room`` messages; settles them some polls later and out of order, and fails what it is told to."""

    def __init__(self, room, fails=()):
        self.room, self.fails = room, dict(fails)
        self.buffer, self.log, self.most, self.refused, self.now = [], [], 0, 0, 0.0

    def send(self, key, body, done):
        if body is None:
            raise ValueError("empty body")
        if len(self.buffer) >= self.room:
            self.refused += 1
            raise BufferError("queue full")
        self.buffer.append((key, body, done))
        self.most = max(self.most, len(self.buffer))

    def poll(self, seconds):
        self.now += seconds
        for key, body, done in self.buffer[::-1][: self.room // 2 + 1]:
            self.buffer.remove((key, body, done))
            if self.fails.get(body, 0) > 0:
                self.fails[body] -= 1
                done("timed out")
            else:
                self.log.append((key, body))
                done(None)


def deliver(messages, broker, window, attempts=5):
    waits = []

    def pause(seconds):
        waits.append(seconds)
        broker.now += seconds

    delivery = sinks.Delivery(broker, window, attempts, 0.1, clock=lambda: broker.now, pause=pause)
    return list(delivery.run(iter(messages))), delivery, waits


def test_delivery_reports_every_message_in_order_per_key():
    messages = [(f"k{i % 7}", f"m{i}") for i in range(500)] + [(None, "n1"), ("k1", None), ("k1", "last"), (None, "n2")]
    broker = Broker(10, {"m3": 2, "m70": 9, "m100": 1})
    report, delivery, _ = deliver(messages, broker, 50, attempts=4)
    assert len(report) == len(messages) and delivery.most <= 50 and broker.most <= 10 and delivery.held == 0
    for key in {k for k, _ in messages}:
        sent = [b for k, b in broker.log if k == key]
        assert sent == [b for k, b in messages if k == key and b not in (None, "m70")]
    failed = [r for r in report if r[1] == "failed"]
    assert sorted(map(str, failed)) == sorted(map(str, [("k0", "failed", "timed out", 4), ("k1", "failed", "empty body", 4)]))
    assert sorted(r[3] for r in report if r[1] == "success" and r[3] > 1 and r[2] is None)[-1] >= 3


def test_full_buffer_is_tried_again_later():
    """A buffer of one: refusals pause that message, and everything arrives."""
    broker = Broker(1)
    report, delivery, _ = deliver([(f"k{i}", f"m{i}") for i in range(40)], broker, 8, attempts=60)
    assert broker.refused > 0 and {r[1] for r in report} == {"success"} and len(broker.log) == 40 and delivery.most <= 8


def test_pauses_double():
    broker = Broker(5, {"m": 3})
    report, _, waits = deliver([("k", "m")], broker, 4, attempts=4)
    assert report == [("k", "success", None, 4)]
    assert [round(w + 0.1, 3) for w in waits] == [0.1, 0.2, 0.4] or len(waits) >= 2 and waits == sorted(waits)
