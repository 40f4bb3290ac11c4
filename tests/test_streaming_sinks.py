import glob
import os

import pytest
from pyspark.sql import functions as F

from clickweave.operators import extract, quality
from clickweave.plans.batch import run_batch
from clickweave.schemas import ATTRIBUTES
from clickweave.sinks import tables as sinks
from clickweave.sources.decode import parse_messages, parse_sessions
from clickweave.sources.derived import session_messages, session_records
from clickweave.streaming import ingest, pageviews
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def session_files(spark, tmp_path_factory):
    """Session JSONL from sf0.001 split into two files by publish time."""
    root = tmp_path_factory.mktemp("sessions")
    rec = session_records(spark, SF_SMALL).orderBy("publish_time").collect()
    half = len(rec) // 2
    for name, chunk in (("a.jsonl", rec[:half]), ("b.jsonl", rec[half:])):
        with open(root / name, "w") as f:
            for r in chunk:
                f.write(r.value + "\n")
        # a line that must become a record reject
    with open(root / "b.jsonl", "a") as f:
        f.write("not json\n")
    return str(root), len(rec)


def test_provision_idempotent(spark):
    a = sinks.provision(spark, "prov_t")
    b = sinks.provision(spark, "prov_t")
    assert a == b
    cols = {f.name: f.nullable for f in spark.table("prov_t.events").schema.fields}
    assert {"event_date", "load_id"} < set(cols) and len(cols) == 18
    props = dict(spark.sql("SHOW TBLPROPERTIES prov_t.visits").collect())
    assert props.get("zone") == "prov_t"


def test_batch_job_append_twice_then_dedup(spark, session_files):
    path, n = session_files
    m1 = run_batch(spark, path, database="batch_t")
    m2 = run_batch(spark, path, database="batch_t")
    assert m1 == m2
    assert m1["input_records"] == n + 1 and m1["record_rejects"] == 1
    v = spark.table("batch_t.visits")
    assert v.count() == 2 * n
    assert quality.dedup(v, ["session_id"]).count() == n
    e = spark.table("batch_t.events")
    assert quality.dedup(e, ["session_id", "event_unique_id"]).count() == m1["events_rows"]
    runs = spark.table("batch_t.job_runs").collect()
    assert len(runs) == 2 and runs[0].metrics["visits_rows"] == n


def test_batch_fanout_modes_agree(spark, session_files):
    path, _ = session_files
    a = run_batch(spark, path, database="fan_ckpt", fanout="checkpoint")
    b = run_batch(spark, path, database="fan_persist", fanout="persist")
    assert a == b
    a, b = (spark.table(f"{d}.events").drop("load_id") for d in ("fan_ckpt", "fan_persist"))
    assert a.exceptAll(b).count() == 0


def test_file_stream_matches_batch_and_archives(spark, session_files, tmp_path):
    src, n = session_files
    inp = tmp_path / "in"
    inp.mkdir()
    files = sorted(glob.glob(os.path.join(src, "*.jsonl")))
    archive = tmp_path / "archive"
    ckpt = str(tmp_path / "ckpt")

    def run():
        lines = ingest.file_sessions_stream(spark, str(inp), archive_dir=str(archive), max_files_per_trigger=1)
        q = ingest.start_live_ingest(ingest.parse_file_stream(lines), "file_stream_t", ckpt, profile="batch")
        q.awaitTermination(300)

    # first catch-up run sees file a, the second sees b, the third nothing new
    for f in files:
        (inp / os.path.basename(f)).write_text(open(f).read())
        run()
    run()
    got = spark.table("file_stream_t.events").drop("event_date", "load_id")
    want = extract.events(parse_sessions(spark.read.text(src).withColumn("source", F.lit("x"))), "batch")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
    assert spark.table("file_stream_t.visits").count() == n
    assert spark.table("file_stream_t.rejects").where("stage = 'record'").count() == 1
    # a batch's files are archived when the next batch is planned
    archived = [os.path.basename(p) for p in glob.glob(str(archive) + "/**/*.jsonl", recursive=True)]
    assert archived == ["a.jsonl"]
    assert sorted(os.listdir(inp)) == ["b.jsonl"]


def test_foreach_batch_replay_is_idempotent(spark):
    msgs = session_messages(spark, SF_SMALL)
    parsed = parse_messages(msgs)
    sinks.provision(spark, "replay_t")
    ingest.write_batch_tables(parsed, "replay_t", 7)
    ingest.write_batch_tables(parsed, "replay_t", 7)
    ingest.write_batch_tables(parsed.limit(5), "replay_t", 8)
    ingest.write_batch_tables(parsed.limit(3), "replay_t", 8)  # a smaller attempt leaves nothing of the larger one
    v = spark.table("replay_t.visits")
    assert v.where("load_id = 'live-7'").count() == msgs.count()
    assert v.where("load_id = 'live-8'").count() == 3


def test_failed_run_written_again_does_not_double(spark, session_files, monkeypatch):
    path, n = session_files
    real = sinks.write_attempt

    def failing(df, name, *a, **kw):
        if name == "purchase_items":
            raise RuntimeError("lost")
        return real(df, name, *a, **kw)

    monkeypatch.setattr(sinks, "write_attempt", failing)
    with pytest.raises(RuntimeError):
        run_batch(spark, path, database="retry_t", run_id="7")
    assert spark.table("retry_t.visits").count() == spark.table("retry_t.events").count() == 0  # nothing was committed
    monkeypatch.setattr(sinks, "write_attempt", real)
    m = run_batch(spark, path, database="retry_t", run_id="7")
    assert spark.table("retry_t.visits").count() == n == m["visits_rows"]
    assert spark.table("retry_t.events").count() == m["events_rows"]


def test_modes(spark, tmp_path):
    import json

    from tests.conftest import ev, session

    def day(d, sid):
        f = tmp_path / f"{sid}.jsonl"
        f.write_text(json.dumps(session(sid, [ev(timestamp=f"2024-01-0{d}T10:00:00")])) + "\n" + json.dumps(session(sid + "-untimed", [])))
        return str(f)

    def load(path, mode):
        run_batch(spark, path, database="modes_t", mode=mode, glob=None)
        v = spark.table("modes_t.visits")
        return sorted(r.session_id for r in v.collect()), sorted(r.session_id for r in spark.table("modes_t.events").collect())

    assert load(day(1, "a"), "append") == (["a", "a-untimed"], ["a"])
    assert load(day(2, "b"), "append") == (["a", "a-untimed", "b", "b-untimed"], ["a", "b"])
    # day 1 and the visits without a day are replaced, day 2 stays
    assert load(day(1, "c"), "replace_days") == (["b", "c", "c-untimed"], ["b", "c"])
    assert load(day(3, "d"), "truncate") == (["d", "d-untimed"], ["d"])
    with pytest.raises(ValueError, match="mode"):
        load(day(3, "d"), "overwrite")


def test_compacted_days_keep_their_rows(spark):
    parsed = parse_messages(session_messages(spark, SF_SMALL))
    sinks.provision(spark, "compact_t")
    for i in range(3):
        ingest.write_batch_tables(parsed.where(F.pmod(F.xxhash64("message_id"), F.lit(3)) == i), "compact_t", i)
    before = spark.table("compact_t.events").collect()
    assert sinks.compact(spark, "events", "compact_t", "2024-01-15")
    assert not sinks.compact(spark, "events", "compact_t", "2024-01-15")  # days of one load are left alone
    after = spark.table("compact_t.events")
    assert sorted(map(str, after.collect())) == sorted(map(str, before))  # load ids included
    sinks.vacuum(spark, "compact_t", 0)
    places = spark.table("compact_t.events_rows").groupBy("event_date").agg(F.count_distinct("attempt").alias("n")).collect()
    assert all(r.n == 1 if str(r.event_date) < "2024-01-15" else r.n <= 3 for r in places) and max(r.n for r in places) == 3
    # a compacted load that is written again still replaces its own rows, and nothing else
    ingest.write_batch_tables(parsed.limit(0), "compact_t", 1)
    left = spark.table("compact_t.events").collect()
    assert sorted(map(str, left)) == sorted(str(r) for r in before if r.load_id != "live-1")


def test_compaction_hides_nothing_that_commits_meanwhile(spark, monkeypatch):
    parsed = parse_messages(session_messages(spark, SF_SMALL))
    sinks.provision(spark, "race_t")
    third = [parsed.where(F.pmod(F.xxhash64("message_id"), F.lit(3)) == i) for i in range(3)]
    for i in range(2):
        ingest.write_batch_tables(third[i], "race_t", i)
    real = sinks.write_attempt

    def slow(df, name, *a):
        monkeypatch.setattr(sinks, "write_attempt", real)
        ingest.write_batch_tables(third[2], "race_t", 2)  # a live load commits while the days are gathered
        return real(df, name, *a)

    monkeypatch.setattr(sinks, "write_attempt", slow)
    for t in ("events", "rejects", "visits"):
        sinks.compact(spark, t, "race_t", "2999-01-01")
    assert sinks.vacuum(spark, "race_t", 24) == 0  # too young
    assert sinks.vacuum(spark, "race_t", 0) > 0
    assert sinks.vacuum(spark, "race_t", 0) == 0
    whole = extract.tables(parsed, "live")
    for t in ("events", "purchase_items"):
        got = spark.table(f"race_t.{t}").select(*whole[t].columns)
        assert got.exceptAll(whole[t]).count() == 0 and got.count() == whole[t].count()
    assert spark.table("race_t.rejects").count() == whole["rejects"].count()
    assert spark.table("race_t.visits").count() == extract.visits(parsed).count()
    # a replay after all that changes nothing
    ingest.write_batch_tables(third[0], "race_t", 0)
    assert spark.table("race_t.events").count() == whole["events"].count()


def test_empty_loads_commit(spark):
    sinks.provision(spark, "empty_t")
    none = parse_messages(session_messages(spark, SF_SMALL).limit(0))
    m = ingest.write_batch_tables(none, "empty_t", 0)
    assert set(m.values()) == {0} and spark.table("empty_t.loads").count() == 1
    assert sinks.compact(spark, "rejects", "empty_t", "2999-01-01") == []


def test_batch_archives_what_it_read(spark, session_files, tmp_path):
    import shutil

    src, n = session_files
    shutil.copytree(src, tmp_path / "in")
    m = run_batch(spark, str(tmp_path / "in"), database="archive_t", archive_dir=str(tmp_path / "done"))
    assert m["visits_rows"] == n
    assert not glob.glob(str(tmp_path / "in/*.jsonl"))
    assert sorted(os.path.basename(p) for p in glob.glob(str(tmp_path / "done/**/*.jsonl"), recursive=True)) == ["a.jsonl", "b.jsonl"]
    assert run_batch(spark, str(tmp_path / "in"), database="archive_t")["input_records"] == 0
    # a file that comes back under its name, with other content, is another file
    (tmp_path / "in/a.jsonl").write_text('{"session_id":"NEW"}\n')
    m = run_batch(spark, str(tmp_path / "in"), database="archive_t", run_id="9", archive_dir=str(tmp_path / "done"))
    assert m["visits_rows"] == 1 and not glob.glob(str(tmp_path / "in/*.jsonl"))
    # the same run again has nothing to do and takes nothing away
    assert run_batch(spark, str(tmp_path / "in"), database="archive_t", run_id="9", archive_dir=str(tmp_path / "done")) == m
    assert spark.table("archive_t.visits").count() == n + 1
    assert spark.table("archive_t.files").count() == 3


def test_replayed_messages_are_dropped(spark, tmp_path):
    msgs = session_messages(spark, SF_SMALL)
    msgs.unionByName(msgs).write.parquet(str(tmp_path / "m"))
    stream = parse_messages(ingest.without_replays(ingest.message_files_stream(spark, str(tmp_path / "m")), "60 days"))
    ingest.start_live_ingest(stream, "dropped_t", str(tmp_path / "ck")).awaitTermination(300)
    assert spark.table("dropped_t.visits").count() == msgs.count()


def test_flush_closes_the_last_window(spark, tmp_path):
    msgs = session_messages(spark, SF_SMALL)
    msgs.unionByName(pageviews.flush_message(msgs, 60)).write.parquet(str(tmp_path / "m"))
    stream = ingest.message_files_stream(spark, str(tmp_path / "m"))
    ingest.start_page_views(stream, "flush_t", str(tmp_path / "k"), window_minutes=60).awaitTermination(300)
    got = spark.table("flush_t.page_views").select("window_end", "page_view_count")
    batch = pageviews.page_view_counts(parse_messages(msgs), 60)
    assert got.count() == batch.count() and got.exceptAll(batch).count() == 0


def test_page_view_stream_equals_batch_on_closed_windows(spark, tmp_path):
    msgs = session_messages(spark, SF_SMALL)
    cut = msgs.agg(F.expr("percentile_approx(publish_time, 0.5)")).first()[0]
    src = tmp_path / "msgs"
    msgs.where(F.col("publish_time") < F.lit(cut)).write.parquet(str(src / "p1"))
    ckpt = str(tmp_path / "k")

    def run():
        stream = ingest.message_files_stream(spark, str(src) + "/*")
        q = ingest.start_page_views(stream, "closed_t", ckpt, window_minutes=60, threshold=3)
        q.awaitTermination(300)

    run()
    msgs.where(F.col("publish_time") >= F.lit(cut)).write.parquet(str(src / "p2"))
    run()
    batch = pageviews.page_view_counts(parse_messages(msgs), 60)
    max_pt = msgs.agg(F.max("publish_time")).first()[0]
    closed = batch.where(F.col("window_end") <= F.lit(max_pt))
    got = spark.table("closed_t.page_views").select("window_end", "page_view_count")
    assert got.count() == closed.count() > 0
    assert got.exceptAll(closed).count() == 0
    al = spark.table("closed_t.page_view_alerts")
    assert al.count() == closed.where("page_view_count > 3").count()


def test_late_rows_are_rejects(spark, tmp_path):
    import datetime as dt

    from clickweave.schemas import MESSAGE

    def m(i, t):
        data = ('{"session_id":"S%d","events":[{"event":{"event_type":"page_view"}}]}' % i).encode()
        return (f"m{i}", t, [], data)

    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    src = tmp_path / "msgs"
    spark.createDataFrame([m(1, t0), m(2, t0 + dt.timedelta(minutes=5))], MESSAGE).write.parquet(str(src / "p1"))
    ckpt, dropped = str(tmp_path / "k"), []

    def run():
        stream = ingest.message_files_stream(spark, str(src) + "/*")
        q = ingest.start_page_views(stream, "late_t", ckpt, window_minutes=1)
        q.awaitTermination(300)
        dropped.append(sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators))

    run()
    # late: 10:00:30 arrives after the watermark moved to 10:05
    spark.createDataFrame([m(3, t0 + dt.timedelta(seconds=30)), m(4, t0 + dt.timedelta(minutes=9))],
                          MESSAGE).write.parquet(str(src / "p2"))
    run()
    got = {str(r.window_end): r.page_view_count for r in spark.table("late_t.page_views").collect()}
    assert got == {"2024-01-01 10:01:00": 1, "2024-01-01 10:06:00": 1}
    rejects = spark.table("late_t.rejects").collect()
    assert [(r.source, r.reason, r.session_id, r.payload) for r in rejects] == [("m3", "late", "S3", '{"publish_time":"2024-01-01T10:00:30.000000","page_views":1}')]
    assert dropped == [0, 1]  # what Spark says it dropped
    # a batch that is written again is judged as the first time
    sinks.vacuum(spark, "late_t", 0)
    assert spark.table("late_t.rejects").count() == 1


def test_lateness_is_that_of_the_stream(spark, tmp_path):
    """Messages by chance over many batches: counted and late together are all of them, and late are those that Spark dropped."""
    msgs = session_messages(spark, SF_SMALL)
    src, dropped = tmp_path / "msgs", 0
    for i in range(5):
        msgs.where(F.pmod(F.xxhash64("message_id"), F.lit(5)) == i).coalesce(1).write.parquet(str(src / str(i)))
    stream = ingest.message_files_stream(spark, str(src) + "/*", max_files_per_trigger=1)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1000")
    q = ingest.start_page_views(stream, "chance_t", str(tmp_path / "k"), window_minutes=60, watermark="3 days")
    q.awaitTermination(300)
    dropped = sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators)
    late = spark.table("chance_t.rejects").where("reason = 'late'")
    assert late.count() >= dropped > 0  # Spark counts after a partial sum by window
    counted = spark.table("chance_t.page_views").agg(F.sum("page_view_count")).first()[0]
    missed = late.agg(F.sum(F.get_json_object("payload", "$.page_views").cast("long"))).first()[0]
    last = spark.table("chance_t.page_views").agg(F.max("window_end")).first()[0]
    batch = pageviews.page_view_counts(parse_messages(msgs), 60)
    limit = msgs.agg(F.max("publish_time") - F.expr("INTERVAL 3 DAYS")).first()[0]
    open_windows = batch.where(F.col("window_end") > F.lit(limit))
    still = open_windows.agg(F.sum("page_view_count")).first()[0] or 0
    assert counted + missed <= batch.agg(F.sum("page_view_count")).first()[0] and last <= limit
    # of closed windows nothing is missing
    closed = batch.where(F.col("window_end") <= F.lit(limit)).agg(F.sum("page_view_count")).first()[0]
    ends = F.window(F.get_json_object("payload", "$.publish_time").cast("timestamp"), "60 minutes")["end"]
    missed_closed = late.where(ends <= F.lit(limit)).agg(F.sum(F.get_json_object("payload", "$.page_views").cast("long"))).first()[0]
    assert counted + missed_closed == closed and still >= 0


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(10,), (11,)], "page_view_count long").withColumn("window_end", F.current_timestamp())
    got = [r.page_view_count for r in pageviews.page_view_alerts(df, 10).collect()]
    assert got == [11]


def test_raw_landing_keeps_every_message(spark, tmp_path):
    msgs = session_messages(spark, SF_SMALL)
    odd = spark.createDataFrame([("nl", bytearray(b'{"a":1,\n\r\n"b":2}\n')), ("bytes", bytearray(b"\xff\xfe\n")), ("none", None)] + [(f"hot{i}", bytearray(b"x")) for i in range(100)], "message_id string, data binary")
    msgs = msgs.unionByName(odd.select("message_id", F.lit("2024-01-05 10:00:00").cast("timestamp").alias("publish_time"), F.array(*(F.struct(F.lit("h").alias("key"), F.lit(v).alias("value")) for v in ("b", "a", None))).alias("attributes"), "data"))
    msgs = msgs.unionByName(msgs.where("message_id = 'nl'").withColumns({"message_id": F.lit("untimed"), "publish_time": F.lit(None).cast("timestamp"), "attributes": F.lit(None).cast(ATTRIBUTES)}))
    src = tmp_path / "msgs"
    msgs.write.parquet(str(src))
    out, ckpt = str(tmp_path / "raw"), str(tmp_path / "k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these partitions are all small
    q = ingest.start_raw_landing(ingest.message_files_stream(spark, str(src)), out, ckpt, num_shards=5, rows_per_file=10)
    q.awaitTermination(300)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = pageviews.read_raw_landing(spark, out)
    assert back.count() == msgs.count()
    same = [f.select("message_id", "publish_time", "attributes", "data") for f in (back, msgs)]
    assert back.where("publish_time is null").count() == 1
    assert same[0].exceptAll(same[1]).count() == 0
    assert {r.shard for r in back.select("shard").distinct().collect()} == {"00", "01", "02", "03", "04"}
    assert all(r.minute is None or len(r.minute) == len("2024-01-01-T-00-00") for r in back.select("minute").distinct().collect())
    # the rows of a hot hour are spread over files, a quiet hour is one file
    assert len(glob.glob(out + "/batch_id=0/hour=2024-01-05-10/part-*")) > 3
    assert all(len(glob.glob(d + "/part-*")) == 1 for d in glob.glob(out + "/batch_id=0/hour=*") if not d.endswith("2024-01-05-10"))


def test_live_dashboard_updates(spark, tmp_path):
    from clickweave.operators import reports

    msgs = session_messages(spark, SF_SMALL).repartition(3)
    src = tmp_path / "msgs"
    msgs.write.parquet(str(src))
    stream = parse_messages(ingest.message_files_stream(spark, str(src), max_files_per_trigger=1))
    aggs = ingest.live_dashboard_aggregates(stream, lateness="60 days")
    for name, agg in aggs.items():
        ingest.start_updates(agg, str(tmp_path / name), str(tmp_path / f"ck_{name}")).awaitTermination(300)
    batch = parse_messages(msgs)
    items = extract.purchase_items(batch, "live")
    want = {
        "visits_by_device": reports.visits_by_device(extract.visits(batch)),
        "sales_by_category": reports.sales_by_category(items),
        "product_totals": reports.popular_items(items, 10**6),
        "visits_by_page": reports.visits_by_page(extract.events(batch)),
    }
    for name, df in want.items():
        for gathered in (0, 2):  # batches that a compaction gathers; the log reads the same
            if gathered:
                assert ingest.compact_updates(spark, str(tmp_path / name), ["day", ingest.DASHBOARD[name][0]]) >= gathered
            got = ingest.read_dashboard(spark, str(tmp_path / name), name).select(*df.columns)
            assert got.exceptAll(df).count() == 0 and got.count() == df.count(), name
    pages = ingest.read_dashboard(spark, str(tmp_path / "visits_by_page"), "visits_by_page").collect()
    assert all(abs(r.sessions_estimate - r.visits) <= 0.1 * r.visits + 1 for r in pages)


def test_dashboard_state_is_evicted(spark, tmp_path):
    """Every stateful operator of the dashboards has a watermark, and days that it has passed leave the state."""
    import datetime as dt

    from clickweave.schemas import MESSAGE

    data = b'{"session_id":"S%d","device_type":"d","events":[{"event":{"event_type":"page_view","timestamp":"2024-01-01","details":{"page_url":"p"}}}]}'
    rows = [(f"m{d}-{i}", dt.datetime(2024, 1, 1 + d, 10), [], data % i) for d in range(8) for i in range(5)]
    for d in range(8):
        spark.createDataFrame([r for r in rows if r[0].startswith(f"m{d}-")], MESSAGE).coalesce(1).write.parquet(str(tmp_path / f"msgs/{d:02d}"))
    for name in ingest.DASHBOARD:
        stream = ingest.without_replays(ingest.message_files_stream(spark, str(tmp_path / "msgs/*"), max_files_per_trigger=1), "1 day")
        agg = ingest.live_dashboard_aggregates(parse_messages(stream))[name]
        plan = agg._jdf.queryExecution().analyzed().toString()
        assert "EventTimeWatermark" in plan
        q = ingest.start_updates(agg, str(tmp_path / name), str(tmp_path / f"ck_{name}"))
        q.awaitTermination(300)
        for operator in q.lastProgress.stateOperators:
            assert operator.numRowsTotal <= 4 * 5, (name, operator.operatorName)  # a few days of five rows, not eight
    got = {r.page_url: (r.visits, r.sessions_estimate) for r in ingest.read_dashboard(spark, str(tmp_path / "visits_by_page"), "visits_by_page").collect()}
    assert got == {"p": (40, 5)}  # by day a session counts each day; sketches know that they are five


def test_raw_zone_landing(spark, session_files):
    path, n = session_files
    run_batch(spark, path, database="batch_raw_t", land_raw_lines=True)
    assert spark.table("raw.sessions_raw").count() == n + 1


def test_cli_batch_and_page_views(spark, session_files, tmp_path):
    from clickweave.plans import cli

    path, n = session_files
    m = cli.main(["batch", "--input", path, "--database", "cli_t", "--mode", "truncate", "--fanout", "persist"], spark)
    assert m["visits_rows"] == n
    msgs = session_messages(spark, SF_SMALL)
    msgs.write.parquet(str(tmp_path / "msgs"))
    cli.main(["page-views", "--source", "files-parquet", "--input", str(tmp_path / "msgs"), "--database",
              "cli_pv_t", "--checkpoint", str(tmp_path / "ck"), "--window-minutes", "60",
              "--raw-output", str(tmp_path / "raw")], spark)
    assert spark.table("cli_pv_t.page_views").count() > 0
    assert pageviews.read_raw_landing(spark, str(tmp_path / "raw")).count() == msgs.count()
    with pytest.raises(SystemExit):  # lines are no messages
        cli.main(["page-views", "--source", "files-jsonl", "--checkpoint", "y"], spark)
    cli.main(["live-ingest", "--source", "files-jsonl", "--input", path, "--database", "cli_live_t", "--checkpoint", str(tmp_path / "ckl")], spark)
    assert spark.table("cli_live_t.visits").count() == n
    cli.main(["batch", "--input", path, "--database", "cli_t", "--skip-known", "--land-raw", "--run-id", "again"], spark)
    assert spark.table("cli_t.visits").count() == n
    cli.main(["derive", "--database", "cli_derived_t"], spark)
    assert spark.table("cli_derived_t.visits").where("load_id = 'derived-batch_sessions-again'").count() == n
    assert cli.main(["publish", "--database", "cli_t", "--buckets", "2"], spark)["dropped"] == []


def test_raw_landing_is_compressed(spark, tmp_path):
    msgs = session_messages(spark, SF_SMALL)
    msgs.write.parquet(str(tmp_path / "msgs"))
    out = str(tmp_path / "raw")
    ingest.start_raw_landing(ingest.message_files_stream(spark, str(tmp_path / "msgs")), out, str(tmp_path / "k")).awaitTermination(300)
    files = glob.glob(out + "/batch_id=0/hour=*/part-*")
    assert files and all(f.endswith(".txt.gz") for f in files)
    assert pageviews.read_raw_landing(spark, out).count() == msgs.count()


def test_streams_share_decoded_records(spark, tmp_path):
    """F8: one stream drops replays and decodes; streams that read its records see each once, however often it is started."""
    import datetime as dt

    from clickweave.schemas import MESSAGE

    data = b'{"session_id":"S%d","device_type":"d","events":[{"event":{"event_type":"page_view","timestamp":"2024-01-01","details":{"page_url":"p%d"}}}]}'
    rows = [(f"m{i}", dt.datetime(2024, 1, 1, 10 + i), [], data % (i, i % 2)) for i in range(5)] + [("bad", dt.datetime(2024, 1, 1, 12), [], b"{")]
    for name, some in (("00", rows[:3] + rows[5:]), ("01", rows)):  # the second file says the first again
        spark.createDataFrame(some, MESSAGE).coalesce(1).write.parquet(str(tmp_path / "msgs" / name))
    out = str(tmp_path / "decoded")
    for _ in range(2):
        stream = ingest.without_replays(ingest.message_files_stream(spark, str(tmp_path / "msgs/*"), max_files_per_trigger=1), "1 day")
        ingest.start_decoded(parse_messages(stream), out, str(tmp_path / "ck")).awaitTermination(300)
    back = spark.read.parquet(out)
    assert sorted((r.message_id, r.reject_reason) for r in back.collect()) == [("bad", "bad_json"), *((f"m{i}", None) for i in range(5))]
    for name in ("visits_by_device", "visits_by_page"):
        agg = ingest.live_dashboard_aggregates(ingest.decoded_stream(spark, out), lateness="60 days")[name]
        ingest.start_updates(agg, str(tmp_path / name), str(tmp_path / f"ck_{name}")).awaitTermination(300)
    assert [tuple(r) for r in ingest.read_dashboard(spark, str(tmp_path / "visits_by_device"), "visits_by_device").collect()] == [("d", 5)]
    pages = ingest.read_dashboard(spark, str(tmp_path / "visits_by_page"), "visits_by_page").collect()
    assert {r.page_url: r.visits for r in pages} == {"p0": 3, "p1": 2}
