"""Envelope edge cases, restart, replay, late data."""

import pytest
from pyspark.sql import functions as F

from lakeops.operators.merge import Keyed
from lakeops.operators.quality import not_null_rules, positive_rule
from lakeops.schemas import ORDER_EVENT
from lakeops.sources import streams
from lakeops.streaming import dedup
from lakeops.streaming.envelope import CORRUPT, parse_envelope
from lakeops.streaming.silver import Upsert, gold_refresh, raw_and_clean
from lakeops.streaming.sinks import append_stream, batch_stream, drain, trigger_args


def envelope(spark, values):
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "k string, v string")
    return df.select(F.col("k").cast("binary").alias("key"), F.col("v").cast("binary").alias("value"), F.lit("2026-01-01").cast("timestamp").alias("timestamp"))


def test_envelope_edge_cases(spark):
    values = [
        '{"order_id": "1", "amount": 2.5, "event_ts": "2026-01-12T10:00:00Z"}',
        '{"order_id": "2", "event_ts": "2026-01-12T10:00:00+07:00"}',
        '{"order_id": "3", "amount": "lots", "event_ts": "2026-01-12 10:00:00"}',
        '{"order_id": "4", "event_ts": "soon"}',
        "not json",
        None,
    ]
    out = [r.asDict() for r in parse_envelope(envelope(spark, values), ORDER_EVENT).orderBy("k").collect()]
    assert [r["order_id"] for r in out] == ["1", "2", "3", "4", None, None]
    assert [r["event_ts"].hour if r["event_ts"] else None for r in out] == [10, 3, 10, None, None, None]
    assert [r[CORRUPT] is not None for r in out] == [False, False, True, True, True, False]
    assert out[0]["amount"] == 2.5 and out[1]["amount"] is None and str(out[0]["dt"]) == "2026-01-12"
    assert out[4][CORRUPT] == "not json"


ROWS = "id long, user long, amount double, ts timestamp_ntz, dt date"


def batch(spark, rows):
    raw = spark.createDataFrame(rows, "id long, user long, amount double, ts string")
    return raw.withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("dt", F.to_date("ts"))


def rules():
    return {**not_null_rules(["id", "user", "ts"]), **positive_rule("amount")}


@pytest.fixture
def sink(spark, folder):
    table = Keyed(folder("silver"), ["id"], ["ts"], ["dt"])
    return Upsert(table, rules(), run_log=folder("log"), quarantine_path=folder("q"), registry=folder("reg"))


def test_replayed_batch_is_logged_and_quarantined_once(spark, sink):
    b = batch(spark, [(1, 1, 1.0, "2026-01-01 10:00:00"), (2, None, 1.0, "2026-01-01 10:00:00"), (1, 1, 2.0, "2026-01-01 11:00:00")])
    for _ in range(2):
        sink(b, 0)
    assert [(r["id"], r["amount"]) for r in spark.read.parquet(sink.table.path).collect()] == [(1, 2.0)]
    log = spark.read.parquet(sink.run_log).collect()
    assert [(r["input_rows"], r["output_rows"], r["dq_failed_rows"], r["status"]) for r in log] == [(3, 2, 1, "SUCCESS")]
    assert spark.read.parquet(sink.quarantine_path).count() == 1


def test_batch_without_good_rows_and_empty_batch(spark, sink):
    sink(batch(spark, [(None, 1, 1.0, "2026-01-01 10:00:00")]), 0)
    sink(batch(spark, [(1, 1, 1.0, "2026-01-01 10:00:00")]).limit(0), 1)
    assert [r["output_rows"] for r in spark.read.parquet(sink.run_log).orderBy("batch_id").collect()] == [0, 0]


def test_failed_batch_is_retried_after_restart(spark, sink, folder):
    source, ck = folder("src"), folder("ck")
    batch(spark, [(1, 1, 1.0, "2026-01-01 10:00:00")]).write.parquet(source)
    stream = streams.like_static(spark, source)
    fail = {"on": True}

    def flaky(df, batch_id):
        if fail["on"]:
            raise RuntimeError("executor gone")
        sink(df, batch_id)

    with pytest.raises(Exception):
        drain(batch_stream(stream, flaky, ck))
    fail["on"] = False
    drain(batch_stream(stream, flaky, ck))
    batch(spark, [(1, 1, 3.0, "2026-01-02 10:00:00"), (2, 1, 1.0, "2026-01-01 10:00:00")]).write.mode("append").parquet(source)
    drain(batch_stream(streams.like_static(spark, source), flaky, ck))
    got = sorted((r["id"], r["amount"], str(r["dt"])) for r in spark.read.parquet(sink.table.path).collect())
    assert got == [(1, 3.0, "2026-01-02"), (2, 1.0, "2026-01-01")]


def counts(spark, path):
    return {str(r["dt"]): r["n"] for r in spark.read.parquet(path).collect()}


def test_gold_follows_moved_keys_even_after_a_crash(spark, folder):
    """The only row of a day moves on; the first try dies between the merge and Gold."""
    gold = folder("gold")
    refresh = gold_refresh(gold, ["dt"], lambda s: s.groupBy("dt").agg(F.count("*").alias("n")))
    broken = {"on": False}

    def maybe(silver, touched):
        if broken["on"]:
            raise RuntimeError("driver gone")
        refresh(silver, touched)

    table = Keyed(folder("silver"), ["id"], ["ts"], ["dt"])
    sink = Upsert(table, rules(), run_log=folder("log"), gold=maybe)
    sink(batch(spark, [(1, 1, 1.0, "2026-01-01 10:00:00"), (2, 1, 1.0, "2026-01-02 10:00:00")]), 0)
    assert counts(spark, gold) == {"2026-01-01": 1, "2026-01-02": 1}
    moved = batch(spark, [(1, 1, 1.0, "2026-01-02 11:00:00")])
    broken["on"] = True
    with pytest.raises(RuntimeError):
        sink(moved, 1)
    broken["on"] = False
    sink(moved, 1)
    assert counts(spark, gold) == {"2026-01-02": 2}


def test_raw_layer_is_written_once_per_batch(spark, sink, folder):
    raw = folder("raw")
    both = raw_and_clean(raw, sink, ["id", "ts"])
    b = batch(spark, [(1, 1, 1.0, "2026-01-01 10:00:00"), (None, 1, 1.0, "2026-01-01 10:00:00")])
    both(b, 0)
    both(b, 0)
    assert spark.read.parquet(raw).count() == 2 and spark.read.parquet(sink.table.path).count() == 1


@pytest.mark.parametrize("spread", [False, True])
def test_dedup_with_a_hot_key(spark, folder, spread):
    """A third of the rows are copies of one key."""
    source, out = folder("src"), folder("out")
    i = F.col("id")
    rows = spark.range(900).select(F.when(i % 3 == 0, F.lit(-1)).otherwise(i).cast("long").alias("id"), F.lit("2026-01-01").cast("timestamp_ntz").alias("ts"), i.alias("offset"))
    rows.write.parquet(source)
    salt = F.pmod(F.xxhash64("offset"), F.lit(8)) if spread else None
    stream = dedup.first_per_key(streams.like_static(spark, source), ["id"], "ts", "1 hour", spread=salt)
    drain(append_stream(stream, out, folder("ck")))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == sorted({-1} | {n for n in range(900) if n % 3})


def test_watermark_reports_dropped_rows(spark, folder):
    source, out, ck = folder("src"), folder("out"), folder("ck")
    batch(spark, [(1, 1, 1.0, "2026-01-10 00:00:00")]).write.parquet(source)
    schema = spark.read.parquet(source).schema

    def run():
        stream = dedup.first_per_key(streams.files(spark, source, schema), ["id"], "ts", "1 day")
        return drain(append_stream(stream, out, ck))

    run()
    batch(spark, [(2, 1, 1.0, "2026-01-01 00:00:00"), (3, 1, 1.0, "2026-01-09 12:00:00"), (1, 1, 9.0, "2026-01-10 00:00:00")]).write.mode("append").parquet(source)
    q = run()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    assert dropped == 1
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 3]


def test_triggers():
    assert trigger_args("available_now") == {"availableNow": True}
    assert trigger_args("5 seconds") == {"processingTime": "5 seconds"} and trigger_args("default") == {}


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.kafka(spark, "localhost:1", "orders", "earliest")


@pytest.mark.parametrize("name", ["str03_watermark", "str04_dedup_by_key", "str06_late_data"])
def test_rows_do_not_depend_on_micro_batches(spark, monkeypatch, name):
    from check import compare, duck

    from lakeops.queries import ORACLES, QUERIES, streams
    from tests.conftest import SF

    monkeypatch.setattr(streams, "BATCH", 1)  # a file a batch
    verdict = compare(QUERIES[name](spark, SF).toArrow(), duck(SF).sql(ORACLES[name]).to_arrow_table())
    assert verdict.startswith("ok"), verdict


def test_late_rows_are_kept_aside_for_any_micro_batches(spark, folder):
    """Accepted and late rows together are the input, by the greatest time of earlier batches."""
    from datetime import datetime, timedelta, timezone

    from lakeops.streaming.late import DELAY, LateSplit

    zero = datetime(2026, 1, 1, tzinfo=timezone.utc)
    # Seconds after zero; a null, and times exactly at the watermark and just behind it.
    times = [0, 100, 95, 90, 89, None, 300, 10, 290, 289, 100, 300, 299]
    data = [(i, None if s is None else zero + timedelta(seconds=s)) for i, s in enumerate(times)]
    for size in (1, 3, 13):
        out, notes, aside = folder("out"), folder("notes"), folder("aside")

        def sink(df, batch_id, out=out):
            df.write.mode("overwrite").parquet(f"{out}/b={batch_id}")

        split = LateSplit("ts", 10, notes, aside, sink)
        want, greatest = {}, None
        for n, at in enumerate(range(0, len(data), size)):
            part = data[at : at + size]
            for i, _ in part:
                s = times[i]
                late = greatest is not None and s is not None and s < greatest - 10
                want[i] = float(greatest - 10 - s) if late else None
            greatest = max([s for s in times[: at + size] if s is not None], default=None)
            batch = spark.createDataFrame(part, "id int, ts timestamp")
            for _ in range(2 if n in (1, 2) else 1):
                split(batch, n)
        late = {r["id"]: r[DELAY] for r in split.late_rows(spark).collect()}
        kept = [r["id"] for r in spark.read.parquet(out).collect()]
        assert sorted([*kept, *late]) == list(range(len(data)))
        assert late == {i: d for i, d in want.items() if d is not None}


def test_late_split_forgets_old_notes_and_a_batch_cut_off(spark, folder, monkeypatch):
    from lakeops.streaming import late as module

    monkeypatch.setattr(module, "_KEPT", 1)
    calls = []

    def sink(df, batch_id):
        calls.append(df.count())
        if calls == [1, 1, 0]:
            raise OSError("cut off")

    split = module.LateSplit("ts", 0, folder("notes"), folder("aside"), sink)
    days = [spark.sql(f"SELECT TIMESTAMP'2026-01-0{d} 00:00:00' AS ts") for d in (1, 3, 2, 4)]
    split(days[0], 0)
    split(days[1], 1)
    with pytest.raises(OSError):
        split(days[2], 2)
    split(days[2], 2)
    split(days[3], 3)
    assert calls == [1, 1, 0, 0, 1] and [r[module.DELAY] for r in split.late_rows(spark).collect()] == [86400.0]
    assert sorted(split._batches(spark)) == [2, 3]
