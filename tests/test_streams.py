"""Streams against their batch forms, with restarts and broken batches."""

import datetime
import json
import threading

import pytest
from pyspark.sql import functions as F

from wasteflow.sources.versioned import Conflict, VersionedTable
from wasteflow.streaming import intake
from wasteflow.streaming.delivery import Outbox, into_table
from wasteflow.streaming.runlog import RunLog, watched
from wasteflow.streaming.stateful import plateau_stream

SCHEMA = "series string, at timestamp, n long"


def checks(spark, rows):
    start = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(s, start + datetime.timedelta(minutes=m), n) for s, m, n in rows], SCHEMA)


def test_plateau_stream_equals_batch_after_a_restart(spark, tmp_path):
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows = [(s, m, [5, 5, 5, 7, 7, 7, 7, 2, 2, 900][(m // 3 + k) % 10]) for k, s in enumerate(("a", "b")) for m in range(40)]
    parts = [[r for r in rows if r[1] % 40 < 13], [r for r in rows if 13 <= r[1] < 29], [r for r in rows if r[1] >= 29]]

    def go():
        stream = plateau_stream(spark.readStream.schema(SCHEMA).parquet(source), 3, 4, 800)
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None

    for i, part in enumerate(parts):
        checks(spark, part[::-1]).repartition(3).write.mode("append").parquet(source)
        if i != 0:
            go()  # a new query object each time, from the checkpoint of the last
    every = checks(spark, rows)
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    want = []
    for s in ("a", "b"):
        batch = intake.plateau_detect(every.where(F.col("series") == s), "at", 3, 4, 800)
        want += map(tuple, batch.select("series", "at", "n", "run", "plateau").collect())
    assert got == sorted(want) and {r[4] for r in got} == {True, False}


def test_late_checks_wait_for_the_watermark(spark, tmp_path):
    """A check that comes after younger ones, within the allowed time, stands in its place; one beyond it is dropped."""
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for rows in ([("a", 0, 9), ("a", 20, 9)], [("a", 15, 9), ("a", 25, 9)], [("a", 2, 1), ("a", 60, 9)]):
        checks(spark, rows).write.mode("append").parquet(source)
        stream = plateau_stream(spark.readStream.schema(SCHEMA).parquet(source), 2, 1, 100, "10 minutes")
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination(120)
    got = sorted((r["at"].minute, r["run"]) for r in spark.read.parquet(out).collect())
    assert got == [(0, 1), (15, 2), (20, 3), (25, 4)]


def test_outbox_replays_without_doubles(spark, tmp_path):
    """A batch dies after some lots; on replay these are not sent again, and no row is missing or doubled."""
    sent = tmp_path / "sent"
    sent.mkdir()
    broken = tmp_path / "broken"
    broken.write_text("")

    def send(token, rows):
        part = int(token.split("-")[1])
        if part >= 5 and broken.exists():
            raise IOError("the other side is down")
        with (sent / f"{token}.json").open("a") as f:
            f.write(json.dumps([r["id"] for r in rows]) + "\n")

    df = spark.range(500).selectExpr("id", "concat('v', id % 7) AS v")
    df.repartition(3).write.parquet(str(tmp_path / "in"))

    def go():
        box = Outbox(spark, str(tmp_path / "box"), ["id"], send, parts=12, parts_in_lot=3, size=20)
        q = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")).writeStream.foreachBatch(box).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        return box, q

    _, q = go()
    with pytest.raises(Exception):
        q.awaitTermination(120)
    before = {f.name: f.read_text() for f in sent.iterdir()}
    assert {int(n.split("-")[1]) for n in before} >= {0, 1, 2}
    broken.unlink()
    box, q = go()
    q.awaitTermination(120)
    files = {f.name: f.read_text().splitlines() for f in sent.iterdir()}
    # The first lot was in the ledger; what broke within a lot comes again as the same chunk.
    assert all(len(lines) == 1 for n, lines in files.items() if int(n.split("-")[1]) < 3)
    assert all(len(set(lines)) == 1 for lines in files.values())
    assert sorted(i for lines in files.values() for i in json.loads(lines[0])) == list(range(500))
    assert box.delivered().agg(F.sum("n")).first()[0] == 500 and box.delivered().count() == 12


def test_table_sink_takes_a_batch_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    put = into_table(table, "w")
    put(spark.range(5), 0)
    put(spark.range(5), 0)
    put(spark.range(5, 9), 1)
    put(spark.range(5), 0)
    assert sorted(r["id"] for r in table.read().collect()) == list(range(9)) and table.version() == 2
    into_table(table, "other")(spark.range(2), 0)
    assert table.read().count() == 11


def test_versions_two_writers_and_a_reader(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    schema = "k int, v string, o int"
    assert table.version() == 0
    with pytest.raises(ValueError):
        table.read()
    table.overwrite(spark.createDataFrame([(1, "a", 0), (2, "b", 0)], schema))
    reader = table.read()
    base = table.version()
    table.upsert(spark.createDataFrame([(2, "c", 1), (3, "d", 1), (3, "e", 2)], schema), ["k"], "o")
    with pytest.raises(Conflict):
        table.overwrite(spark.createDataFrame([(9, "z", 9)], schema), expected=base)
    assert sorted(map(tuple, reader.collect())) == [(1, "a", 0), (2, "b", 0)]
    assert sorted(map(tuple, table.read().collect())) == [(1, "a", 0), (2, "c", 1), (3, "e", 2)]
    # A second writer comes in while the first computes: the first starts again from the newer rows.
    other, turns = VersionedTable(spark, str(tmp_path / "t")), []

    def slow(rows):
        if not turns:
            other.append(spark.createDataFrame([(7, "g", 0)], schema))
        turns.append(1)
        return rows.withColumn("v", F.concat("v", F.lit("!")))

    table.change(slow)
    assert len(turns) == 2 and sorted(r["v"] for r in table.read().collect()) == ["a!", "c!", "e!", "g!"]
    # Appends at one time are all kept.
    threads = [threading.Thread(target=lambda i=i: VersionedTable(spark, str(tmp_path / "t")).append(spark.createDataFrame([(100 + i, "p", 0)], schema))) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert table.read().count() == 8
    table.forget(1)
    assert table.read().count() == 8
    with pytest.raises(ValueError):
        table.append(spark.range(3))


def test_run_log_has_a_row_for_each_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    for i in range(3):
        spark.range(i * 10, i * 10 + 7 + i).selectExpr("id", "IF(id % 4 = 0, 'failed', IF(id % 5 = 0, NULL, 'completed')) AS status").coalesce(1).write.mode("append").parquet(source)
    log = RunLog(spark, str(tmp_path / "log"))
    spark.streams.addListener(log)
    try:
        stream = spark.readStream.schema("id long, status string").option("maxFilesPerTrigger", 1).parquet(source)
        taken = {}
        q = watched(stream, F.col("status") == "failed").writeStream.foreachBatch(lambda d, b: taken.update({b: [r["status"] for r in d.collect()]})).queryName("intake").trigger(availableNow=True).start()
        q.awaitTermination(120)
        bad = watched(stream, F.col("status") == "failed").writeStream.foreachBatch(lambda d, b: 1 / 0).trigger(availableNow=True).start()
        with pytest.raises(Exception):
            bad.awaitTermination(120)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        import time

        for _ in range(40):
            rows = log.rows().collect()
            if sum(r["status"] == "failed" for r in rows) and len(rows) >= 4:
                break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(log)
    done = [r for r in rows if r["status"] == "completed"]
    assert {r["batch"]: (r["processed"], r["failed"]) for r in done} == {b: (sum(s != "failed" for s in v), v.count("failed")) for b, v in taken.items()}
    assert len(done) == len(taken) == 3 and {r["run"] for r in done} == {"intake"}
    assert all(r["started_at"] <= r["completed_at"] for r in done)
    failed = [r for r in rows if r["status"] == "failed"]
    assert len(failed) == 1 and "ZeroDivision" in failed[0]["message"]
