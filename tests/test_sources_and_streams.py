"""Scans, sinks, generators and streaming runs."""

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemill.operators import keyed
from tidemill.plans.shared import run_dir
from tidemill.queries.base import records_of
from tidemill.sources import batches, changes, files, generate, replay, sinks, topics
from tidemill.streaming import runs, timers


@pytest.fixture
def rec(spark, sf):
    return records_of(spark.read.parquet(f"{sf}/events.parquet"))


def test_start_positions(spark, rec):
    path = run_dir(spark, "t")
    assert sinks.write_topic(rec, path) is None
    whole = topics.read_topic(spark, pattern="events-.*", path=path)
    assert whole.count() == rec.count()
    assert topics.read_topic(spark, "events-view", path=path, starting_offsets="latest").count() == 0
    some = topics.read_topic(spark, "events-view", path=path, starting_offsets={("events-view", 0): 20})
    want = rec.filter("topic = 'events-view' AND NOT (partition = 0 AND offset < 20)")
    assert some.count() == want.count()
    assert json.loads(topics.starting_offsets_json({("a", 1): 5, ("a", 0): 3, ("b", 0): 1})) == {"a": {"0": 3, "1": 5}, "b": {"0": 1}}
    for kwargs in ({}, {"topic": "a", "pattern": "b"}, {"topic": "a"}):
        with pytest.raises(ValueError):
            topics.read_topic(spark, **kwargs)
    with pytest.raises(ValueError):
        topics.from_offsets(rec, "middle")
    if not topics.has_kafka(spark):
        with pytest.raises(RuntimeError):
            topics.read_topic(spark, "a", servers="localhost:9092")


def test_csv_headers_are_dropped_per_file(spark, tmp_path):
    for n, body in enumerate(("a,b\n1,x\n2,\"y\n", "a,b\n3,z\n")):
        (tmp_path / f"f{n}.csv").write_text(body)
    (tmp_path / "other.txt").write_text("a,b\n9,9\n")
    assert sorted(r[0] for r in files.read_csv_lines(spark, str(tmp_path)).collect()) == ["1,x", '2,"y', "3,z"]
    (tmp_path / "f0.csv").write_text("a,b\n1,x\n2,y\n")
    assert files.read_csv_dir(spark, str(tmp_path), "a int, b string").count() == 3


def test_changes_to_current_rows(spark):
    def event(op, before, after, ts):
        return json.dumps({"op": op, "before": before, "after": after, "ts_ms": ts}).encode()

    rows = [
        (event("r", None, {"id": 1, "t": 1.5}, 1),),
        (event("c", None, {"id": 2, "t": 2.5}, 2),),
        (event("u", {"id": 1, "t": 1.5}, {"id": 1, "t": 9.0}, 3),),
        (event("d", {"id": 2, "t": 2.5}, None, 4),),
        (None,),
        (b"junk",),
    ]
    log = changes.read_changes(spark.createDataFrame(rows, "value binary"), "id int, t double")
    assert [r["_error"] for r in log.filter("_error IS NOT NULL").collect()] == ["unreadable change event"]
    flat = keyed.unwrap_changes(log.filter("_error IS NULL").drop("_error"))
    assert [(r["id"], r["t"]) for r in keyed.current_rows(flat, ["id"], ["ts_ms"]).collect()] == [(1, 9.0)]
    assert changes.topic_of("p", "db", "orders") == "p.db.orders"


def test_click_generator(spark):
    a = generate.gen_clicks(spark, 1000, seed=3)
    rows = a.collect()
    assert [r["key"]["seq"] for r in rows] == list(range(1000))
    assert len({r["key"]["uuid"] for r in rows}) == 1000 and len(rows[0]["key"]["uuid"]) == 36
    assert {r["value"]["event_type"] for r in rows} == {"navigation"}
    assert set(range(1, 101)) >= {r["value"]["user_id"] for r in rows} and len({r["value"]["user_id"] for r in rows}) > 90
    assert rows == generate.gen_clicks(spark, 1000, seed=3).collect() != generate.gen_clicks(spark, 1000, seed=4).collect()
    assert generate.stream_clicks(spark).isStreaming


def test_demo_topics(spark):
    df = generate.gen_demo_topics(spark, 20)
    stats = {
        r["topic"]: (r["n"], r["p"], r["top"], r["places"])
        for r in df.groupBy("topic")
        .agg(
            F.count("*").alias("n"),
            F.countDistinct("partition").alias("p"),
            F.max("offset").alias("top"),
            F.countDistinct("partition", "offset").alias("places"),
        )
        .collect()
    }
    assert {t: (s[0], s[1]) for t, s in stats.items()} == {
        "demo-orders": (1000, 12), "demo-user-state": (200, 6), "demo-events": (320, 8), "demo-alerts": (100, 3),
    }
    assert all(n == places for n, _, _, places in stats.values())  # offsets are unique per partition
    spans = df.groupBy("topic", "partition").agg(F.count("*").alias("n"), (F.max("offset") + 1).alias("end"))
    assert spans.filter("n != end").count() == 0  # and have no gaps
    many = df.filter("topic = 'demo-user-state'").groupBy("key").agg(F.countDistinct("partition").alias("p"))
    assert many.agg(F.max("p")).first()[0] > 1


def test_replay_in_order(spark):
    df = spark.createDataFrame([(i, f"2024-01-0{i}") for i in range(1, 5)], "id int, d string").withColumn("d", F.to_date("d"))
    rows = sorted((r["seq"], r["loop"], r["id"], str(r["d"])) for r in replay.replay(df, ["id"], loops=1, date_col="d", slices=3).collect())
    assert rows[:4] == [(i, 0, i + 1, f"2024-01-0{i + 1}") for i in range(4)]
    assert rows[4:] == [(4 + i, 1, i + 1, f"2024-01-0{5 + i}") for i in range(4)]
    back = replay.replay(df, ["id"], reverse=True)
    assert [r["id"] for r in back.orderBy("seq").collect()] == [4, 3, 2, 1]


def test_stream_sink_needs_a_checkpoint(spark, sf):
    stream = records_of(files.stream_table(spark, f"{sf}/events.parquet"))
    with pytest.raises(ValueError):
        sinks.write_topic(stream, run_dir(spark, "s"))
    path = run_dir(spark, "s")
    sinks.write_topic(stream, path, checkpoint=run_dir(spark, "c"), trigger=runs.ONCE).awaitTermination()
    assert spark.read.parquet(path).count() == 1000


def test_a_batch_run_again_replaces_itself(spark):
    path = run_dir(spark, "b")
    write = batches.batch_writer(path)
    for _ in range(2):
        write(spark.range(5), 0)
    write(spark.range(3), 1)
    assert spark.read.parquet(path).count() == 8


def test_state_survives_a_restart_between_files(spark, tmp_path):
    """Two files, two runs with one checkpoint: the state goes on from the first."""
    schema = "k int, t bigint, v string"
    source, out, progress = str(tmp_path / "in"), run_dir(spark, "st"), run_dir(spark, "cp")
    for rows in ([(1, 1, "a"), (2, 1, "b"), (1, 2, "c")], [(1, 1, "late"), (2, 5, "d"), (3, 1, "e")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        runs.stream_latest(stream, ["k"], ["t", "v"], out, progress).awaitTermination()
    state = runs.read_latest(spark, out, ["k"], ["t", "v"])
    assert sorted(map(tuple, state.collect())) == [(1, 2, "c"), (2, 5, "d"), (3, 1, "e")]


def test_latest_rows_are_compacted(spark):
    """Many batches, some run again: the table is that of all batches, in few folders."""
    path = run_dir(spark, "kt")
    write, want = runs.keep_latest(path, ["k"], ["t"], every=3), {}
    for batch_id in range(11):
        rows = [(k, batch_id * 10 + k, f"b{batch_id}") for k in range(batch_id % 3, 6, 2)]
        want.update({k: (k, t, v) for k, t, v in rows})
        batch = spark.createDataFrame([*rows, (rows[0][0], -1, "old")], "k int, t int, v string")
        for _ in range(1 + batch_id % 2):
            write(batch, batch_id)
        assert sorted(map(tuple, runs.read_latest(spark, path, ["k"], ["t"]).collect())) == sorted(want.values())
    now = batches.current(batches.folders(spark, path))
    assert [(f.first, f.last, f.compacted) for f in now] == [(0, 8, True), (9, 9, False), (10, 10, False)]
    assert spark.read.parquet(now[0].path).count() == 6


def _small_batches(folder, n, first=0):
    """Batches as a stream of small batches leaves them."""
    for i in range(first, first + n):
        os.makedirs(f"{folder}/batch_id={i}", exist_ok=True)
        pq.write_table(pa.table({"k": [i, i], "v": ["x" * 50, f"v{i}"]}), f"{folder}/batch_id={i}/part-0.parquet")
        open(f"{folder}/batch_id={i}/_SUCCESS", "w").close()


def test_a_day_of_small_batches_is_compacted(spark, tmp_path):
    """17,280 batches (five seconds each for a day) become files of the stated size, and are read back equal."""
    path, n = str(tmp_path / "day"), 17_280
    _small_batches(path, n)
    size = sum(os.path.getsize(f"{path}/batch_id={i}/part-0.parquet") for i in range(n))
    before = batches.read_batches(spark, path).agg(F.count("k"), F.sum("k"), F.countDistinct("v")).first()
    done = batches.compact_batches(spark, path, n - 1, file_bytes=(size + n * batches.OPEN_BYTES) // 8)
    files = [f for f in os.listdir(done.path) if f.endswith(".parquet")]
    assert (done.first, done.last) == (0, n - 1) and 8 <= len(files) <= 10
    assert batches.read_batches(spark, path).agg(F.count("k"), F.sum("k"), F.countDistinct("v")).first() == before
    assert len(batches.read_batches(spark, path).inputFiles()) == len(files)


def test_compaction_can_stop_anywhere(spark, tmp_path):
    path = str(tmp_path / "b")
    _small_batches(path, 6)
    count = lambda: batches.read_batches(spark, path).count()
    os.makedirs(f"{path}/_compacted/0-3")  # a compaction that did not end
    pq.write_table(pa.table({"k": [0], "v": ["half"]}), f"{path}/_compacted/0-3/part-0.parquet")
    os.makedirs(f"{path}/batch_id=6")  # a batch that did not end
    pq.write_table(pa.table({"k": [6], "v": ["half"]}), f"{path}/batch_id=6/part-0.parquet")
    assert count() == 12
    batches.compact_batches(spark, path, 3)
    assert count() == 12 and sorted(f.last for f in batches.current(batches.folders(spark, path))) == [3, 4, 5]
    assert os.path.exists(f"{path}/batch_id=0")  # kept for readers of before
    _small_batches(path, 2, 7)
    assert count() == 16 and batches.compact_batches(spark, path, 7).last == 5  # no further than the batch that did not end
    _small_batches(path, 1, 6)  # which is run again
    batches.compact_batches(spark, path, 7)
    assert not os.path.exists(f"{path}/batch_id=0") and os.path.exists(f"{path}/batch_id=6") and count() == 18
    assert [(f.first, f.last) for f in batches.current(batches.folders(spark, path))] == [(0, 3), (4, 5), (6, 7), (8, 8)]
    assert batches.compact_batches(spark, path, 7) is None and batches.remove_replaced(spark, path) == 0
    batches.compact_batches(spark, path, 8, lambda df: df.filter("v <> 'v1'"))
    assert [(f.first, f.last) for f in batches.current(batches.folders(spark, path))] == [(0, 8)] and count() == 17
    with pytest.raises(ValueError):
        batches.read_batches(spark, str(tmp_path / "none"))


def test_merged_changes_are_the_current_table(spark, tmp_path):
    schema = "id int, op string, ts_ms bigint"
    source, out, progress = str(tmp_path / "in"), run_dir(spark, "mc"), run_dir(spark, "cp")
    for rows in ([(1, "c", 1), (2, "c", 1), (1, "u", 2)], [(2, "d", 3), (3, "c", 4)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        merge = runs.merge_changes(out, ["id"], ["ts_ms"])
        query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", progress).trigger(availableNow=True)
        query.start().awaitTermination()
    log = runs.read_latest(spark, out, ["id"], ["ts_ms"])
    assert sorted((r["id"], r["op"]) for r in keyed.current_rows(log, ["id"], ["ts_ms"]).collect()) == [(1, "u"), (3, "c")]


def test_sessions_merge_in_any_order():
    rng = np.random.default_rng(4)
    for _ in range(200):
        times = rng.integers(0, 400, rng.integers(1, 30))
        want = timers.merged_sessions([], times, 10)
        got = []
        for part in np.array_split(rng.permutation(times), 4):
            got = timers.merged_sessions(got, part, 10)
        assert got == want and sum(n for *_, n in want) == len(times)
        assert all(b[0] - a[1] >= 10 for a, b in zip(want, want[1:]))


def test_one_alert_per_silence_across_restarts(spark, tmp_path):
    """Alerts come once, from the run in which the watermark passes; a key that was silent has no state left."""
    source, out, progress = str(tmp_path / "in"), run_dir(spark, "al"), run_dir(spark, "cp")
    at = lambda h, m=0: f"2024-01-01 {h:02d}:{m:02d}:00"
    runs_ = [
        [("a", at(0)), ("b", at(0, 30)), ("a", at(1, 30)), ("c", at(3))],  # watermark 2:00 then: b is not yet silent for two hours
        [("d", at(5)), ("c", at(4, 30)), ("a", at(3, 10))],  # watermark 4:00; a's row at 3:10 keeps it awake until 5:10
        [("d", at(9)), ("c", at(8))],
        [("d", at(20))],
    ]
    seen = []
    for rows in runs_:
        spark.createDataFrame(rows, "k string, t string").withColumn("t", F.to_timestamp("t")).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("k string, t timestamp").parquet(source)
        alerts = timers.silence_alerts(stream, ["k"], "t", "2 hours", "1 hour")
        runs.append_query(alerts, out, progress).awaitTermination()
        seen.append(sorted((r.k, r.last_seen.strftime("%H:%M"), r.n) for r in spark.read.parquet(out).collect()))
    assert seen[0] == []
    assert seen[1] == [("b", "00:30", 1)]
    assert seen[2] == [("a", "03:10", 3), ("b", "00:30", 1), ("c", "04:30", 2), ("d", "05:00", 1)]
    assert seen[3] == [*seen[2][:3], ("c", "08:00", 1), *seen[2][3:], ("d", "09:00", 1)]
    state = spark.read.format("statestore").option("stateVarName", "open").load(progress)
    assert [r["key"]["k"] for r in state.select("key").distinct().collect()] == ["d"]


def test_a_key_has_one_timer_however_many_sessions_are_open(spark, tmp_path):
    """All sessions that the watermark passes are alerted together; the rest wait for the next timer."""
    source, out, progress = str(tmp_path / "in"), run_dir(spark, "al"), run_dir(spark, "cp")
    got = []
    for days in ([1, 2, 3, 4, 5], [8], [30]):
        rows = [("a" if d < 8 else "b", f"2024-01-{d:02d}") for d in days] + [(None, f"2024-01-{days[0]:02d}")]
        spark.createDataFrame(rows, "k string, t string").withColumn("t", F.to_timestamp("t")).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("k string, t timestamp").parquet(source)
        runs.append_query(timers.silence_alerts(stream, ["k"], "t", "2 hours", "5 days"), out, progress).awaitTermination()
        got.append(sorted((r.k or "-", r.last_seen.day, r.n) for r in spark.read.parquet(out).collect()))
        left = spark.read.format("statestore").option("readRegisteredTimers", True).load(progress)
        n_timers = left.groupBy(F.col("key.k").alias("k")).count().collect()
        assert n_timers and {r["count"] for r in n_timers} == {1}
    assert got[0] == []
    assert got[1] == [("-", 1, 1), ("a", 1, 1), ("a", 2, 1)]
    assert got[2] == [("-", 1, 1), ("-", 8, 1), *[("a", d, 1) for d in (1, 2, 3, 4, 5)], ("b", 8, 1)]


def test_alerts_of_numeric_keys_beside_a_null_key(spark, tmp_path):
    source, out = str(tmp_path / "in"), run_dir(spark, "al")
    rows = [(k, f"2024-01-{d:02d}") for k in (None, 7, (1 << 53) + 1) for d in (1, 1, 3)] + [(1, "2024-01-30")]
    spark.createDataFrame(rows, "k bigint, t string").withColumn("t", F.to_timestamp("t")).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("k bigint, t timestamp").parquet(source)
    runs.append_query(timers.silence_alerts(stream, ["k"], "t", "2 hours", "1 hour"), out, run_dir(spark, "cp")).awaitTermination()
    got = {(r.k, r.last_seen.day, r.n) for r in spark.read.parquet(out).collect()}
    assert got == {(k, d, n) for k in (None, 7, (1 << 53) + 1) for d, n in ((1, 2), (3, 1))}


def test_typed_landing_keeps_rejects(spark):
    from tidemill.operators import registry

    schema = '{"type":"record","name":"R","fields":[{"name":"k","type":"int"}]}'
    reg = spark.createDataFrame([("s", 1, 0, "AVRO", schema)], registry.REGISTRY_SCHEMA)
    rows = spark.createDataFrame([(1, 0, b'{"k":5}'), (2, 7, b"{}")], "n int, sid int, value binary")
    framed = registry.frame_records(rows, F.col("sid")).drop("sid")
    framed = framed.unionByName(spark.createDataFrame([(3, None), (4, b"x")], "n int, value binary"))
    path = run_dir(spark, "typed")
    sinks.land_typed(framed, reg, path)
    assert [(r["n"], r["k"]) for r in sinks.read_landed(spark, path, 0, schema).collect()] == [(1, 5)]
    odd = sinks.read_rejected(spark, path)
    assert {(r["n"], r["_error"]) for r in odd.collect()} == {(2, "unknown schema id"), (3, "missing value"), (4, "frame too short")}


def test_folders_do_not_grow_with_the_registry(spark):
    from tidemill.operators import registry

    schema = '{"type":"record","name":"R","fields":[{"name":"k","type":"int"}]}'
    ids = [*range(600), 7 - (1 << 31), -1, (1 << 31) - 1]
    reg = spark.createDataFrame([(f"s{i}", 1, i, "AVRO", schema) for i in ids], registry.REGISTRY_SCHEMA)
    rows = [(n, i, b'{"k":%d}' % n if n % 3 else b"{}") for n, i in enumerate(ids * 2)]
    framed = registry.frame_records(spark.createDataFrame(rows, "n int, sid int, value binary"), F.col("sid")).drop("sid")
    path = run_dir(spark, "typed")
    sinks.land_typed(framed, reg, path)
    landed = spark.read.parquet(path)
    assert landed.count() == len(rows)
    assert landed.select(sinks.LANDED).distinct().count() <= sinks.FOLDERS + 1
    for sid in (1, 257, 514, *ids[-2:]):
        want = sorted(n for n, i, _ in rows if i == sid and n % 3)
        assert want and sorted(r["n"] for r in sinks.read_landed(spark, path, sid, schema).filter("k = n").collect()) == want
    assert sorted(r["n"] for r in sinks.read_rejected(spark, path).collect()) == [n for n, *_ in rows if not n % 3]


def test_dedupe_with_and_without_salts(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(i % 20, f"2024-01-01 00:00:{i % 60:02d}") for i in range(400)] + [(0, "2024-01-01 00:00:30")] * 300
    df = spark.createDataFrame(rows, "k int, t string").withColumn("t", F.to_timestamp("t"))
    df.repartition(6).write.parquet(source)
    for salts in (1, 4):
        stream = spark.readStream.schema(df.schema).parquet(source)
        out = run_dir(spark, "dd")
        runs.append_query(runs.dedupe_stream(stream, ["k"], "t", "1 hour", salts), out, run_dir(spark, "cp")).awaitTermination()
        assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == list(range(20))


def test_query_progress(spark, sf):
    stream = files.stream_table(spark, f"{sf}/events.parquet")
    query = runs.run_transform(stream, lambda df: df.filter("user_id = 1"), run_dir(spark, "o"), run_dir(spark, "c"))
    query.awaitTermination()
    assert runs.query_lag(query)["input_rows"] >= 0


def test_sessions_are_merged_before_the_shuffle(spark, sf):
    stream = files.stream_table(spark, f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    alerts = runs.silent_keys(stream, ["user_id"], "ts", "1 hour", "1 hour")
    query = runs.append_query(alerts, run_dir(spark, "o"), run_dir(spark, "c"))
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "MergingSessions" in plan[plan.index("Exchange") :]


def test_operators_from_settings(spark):
    from tidemill.functions.settings import arguments_from, configured
    from tidemill.operators.json_ops import flatten_json
    from tidemill.operators.records import regex_filter

    df = spark.createDataFrame([("k", '{"a":{"b":1}}'), ("x", "{}")], "key string, value string")
    assert df.transform(configured(regex_filter, {"PATTERN": "^k$"})).count() == 1
    assert df.transform(configured(regex_filter, {"PATTERN": "b", "MATCH_VALUE": "Yes"})).count() == 1
    assert "a/b" in df.transform(configured(flatten_json, {"FLATTEN_DELIM": "/"})).first()["value"]
    assert arguments_from("frame_records", {"SCHEMA_ID": "7"}) == {"schema_id": 7}
    with pytest.raises(ValueError):
        arguments_from("regex_filter", {})


def test_payload_codecs_are_detected(spark):
    from tidemill.operators import registry

    schema = '{"type":"record","name":"R","fields":[{"name":"a","type":"int"},{"name":"b","type":"string"}]}'
    rows = spark.createDataFrame([(1, 2, "x"), (2, None, None)], "id int, a int, b string")
    plain = registry.encode_rows(rows, schema).collect()
    assert [bytes(r["value"]).decode() for r in plain] == ['{"a":2,"b":"x"}', '{"a":null,"b":null}']
    encoder, decoder = registry.avro_encoder(spark), registry.avro_decoder(spark)
    assert (encoder is None) == (decoder is None)
    assert registry.protobuf_decoder(spark, "M", b"") is None or decoder is not None
    if encoder is not None:
        packed = registry.encode_rows(rows, schema, encoder)
        assert packed.select(decoder(F.col("value"), schema).alias("r")).first()["r"]["a"] == 2


def test_lake_landing_of_streams(spark, sf, rec):
    from tidemill.operators import registry

    source = f"{sf}/events.parquet"
    stream = records_of(files.stream_table(spark, source))
    with pytest.raises(ValueError):
        sinks.land_key_value(stream, run_dir(spark, "kv"))
    path = run_dir(spark, "kv")
    sinks.land_key_value(stream, path, run_dir(spark, "c"), runs.ONCE).awaitTermination()
    assert spark.read.parquet(path).drop("batch_id").count() == rec.count()
    schema = '{"type":"record","name":"R","fields":[{"name":"k","type":"int"}]}'
    reg = spark.createDataFrame([("s", 1, 0, "AVRO", schema)], registry.REGISTRY_SCHEMA)
    props = files.stream_table(spark, source).select("event_id", F.col("props").cast("binary").alias("value"))
    framed = registry.frame_records(props, (F.col("event_id") % 2).cast("int"))
    typed = run_dir(spark, "typed")
    sinks.land_typed_stream(framed, reg, typed, run_dir(spark, "c"), trigger=runs.ONCE).awaitTermination()
    assert sinks.read_landed(spark, typed, 0, reg.first()["schema"]).filter("k IS NOT NULL").count() == 500
    assert sinks.read_rejected(spark, typed).count() == 500


def _operators():
    from tidemill.operators import csv_ops, json_ops, records, registry
    from tidemill.operators.documents import chunk_fixed, chunk_recursive
    from tidemill.operators.redact import redact
    from tidemill.operators.timestamps import convert_ts
    from tidemill.queries.registry_queries import registry_of

    def lookup(df):
        reg = registry_of(df.sparkSession.read.parquet("/root/testdata/sf0.001/supplier.parquet"))
        framed = registry.frame_records(df, (F.col("offset") % 12).cast("int"))
        return registry.with_schema(registry.unframe_records(framed, on_error="drop"), reg)

    conf = {"redactions": [{"path": "user.type", "type": "md5"}, {"path": "props", "type": "drop"}]}
    return {
        "regex": lambda df: records.regex_filter(df, "click", True),
        "project": lambda df: records.project_json(df, {"k": ("props.k", "int")}, on_error="drop", keep=["topic"]),
        "route": lambda df: records.route(df, [(F.col("partition") == 1, "one")], "rest"),
        "flatten": lambda df: json_ops.flatten_json(df, on_error="drop"),
        "paths": json_ops.json_paths,
        "explode": lambda df: json_ops.json_explode(df, "tags"),
        "delete": lambda df: json_ops.json_delete(df, ["user"], on_error="drop"),
        "csv": lambda df: csv_ops.csv_lines_to_json(df),
        "csv record": lambda df: csv_ops.csv_to_record(df),
        "redact": lambda df: redact(df, conf, on_error="drop"),
        "time": lambda df: convert_ts(df, "value", "string[%+]", value="timestamp"),
        "lookup": lookup,
        "chunks": lambda df: chunk_fixed(df.select("offset", F.col("value").cast("string").alias("text")), size=20, overlap=5),
        "recursive": lambda df: chunk_recursive(df.select("offset", F.col("value").cast("string").alias("text")), size=20, overlap=5),
    }


@pytest.mark.parametrize("name", list(_operators()))
def test_stream_equals_batch(spark, sf, rec, name):
    operator = _operators()[name]
    stream = records_of(files.stream_table(spark, f"{sf}/events.parquet"))
    out = run_dir(spark, "eq")
    runs.run_transform(stream, operator, out, run_dir(spark, "c")).awaitTermination()
    want = operator(rec)
    got = spark.read.schema(want.schema).parquet(out)
    assert want.count() > 0
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
