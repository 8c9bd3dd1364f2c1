"""Streaming (STR). Sources are fed file by file and drained, so every query ends."""

import uuid

from pyspark.sql import functions as F

from lakeops.functions.nested import row_hash
from lakeops.operators.aggregate import kpi
from lakeops.operators.key_index import same_key
from lakeops.operators.layout import in_partitions, partition_values, read_if_any
from lakeops.operators.merge import Keyed, apply_changes, merge_versions
from lakeops.operators.quality import not_null_rules, positive_rule, split_rules
from lakeops.operators.staged import StagedTable
from lakeops.operators.windows import latest
from lakeops.queries.registry import Tables, avg_sql, query, sum_sql
from lakeops.queries.scans import BATCH
from lakeops.schemas import ORDER_EVENT
from lakeops.sources import streams
from lakeops.streaming import dedup
from lakeops.streaming.envelope import CORRUPT, clean, parse_envelope, to_envelope
from lakeops.streaming.gold import ChangeGold
from lakeops.streaming.late import DELAY, LateSplit
from lakeops.streaming.silver import Upsert, gold_refresh, raw_and_clean
from lakeops.streaming.sinks import append_stream, batch_stream, drain

VALID = "event_id IS NOT NULL AND user_id IS NOT NULL AND ts IS NOT NULL AND value > 0"

# The base events with bad values, and the corrections that arrive later.
DIRTY_SQL = (
    "SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN user_id END AS user_id, event_type, "
    "CASE WHEN event_id % 17 = 0 THEN -value ELSE value END AS value, CASE WHEN event_id % 19 <> 0 THEN ts END AS ts, 1 AS ingest_rank FROM events"
)
CORRECTED_SQL = "SELECT event_id, user_id, event_type, value + 1 AS value, ts + INTERVAL 1 HOUR AS ts, 2 AS ingest_rank FROM events WHERE event_id % 7 = 0"
SILVER_SQL = (
    f"SELECT event_id, user_id, event_type, value, ts, CAST(ts AS DATE) AS dt FROM ({DIRTY_SQL} UNION ALL {CORRECTED_SQL}) WHERE {VALID} "
    "QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, ingest_rank DESC) = 1"
)
SILVER_COLUMNS = ["event_id", "user_id", "event_type", "value", "ts", "dt"]


def ingest():
    return F.lit("2026-01-12 10:00:00").cast("timestamp")


def rules():
    return {**not_null_rules(["event_id", "user_id", "ts"]), **positive_rule("value")}


def dirty(t: Tables):
    e = F.col("event_id")
    return t.events.select(
        "event_id",
        F.when(e % 13 != 0, F.col("user_id")).alias("user_id"),
        "event_type",
        F.when(e % 17 == 0, -F.col("value")).otherwise(F.col("value")).alias("value"),
        F.when(e % 19 != 0, F.col("ts")).alias("ts"),
        F.lit(1).alias("ingest_rank"),
    ).withColumn("dt", F.to_date("ts"))


def corrected(t: Tables):
    return (
        t.events.filter("event_id % 7 = 0")
        .select(
            "event_id", "user_id", "event_type", (F.col("value") + 1).alias("value"),
            (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ts"), F.lit(2).alias("ingest_rank"),
        )
        .withColumn("dt", F.to_date("ts"))
    )


# Longer than the events' span: no row is late, so the rows that stay do not depend on the micro-batches.
SPAN = "60 days"


def feed(t: Tables, parts, start, fmt: str = "parquet") -> None:
    """Append each part to one directory and drain the stream after each: a stop and a restart every time."""
    source, checkpoint = t.scratch("feed"), t.scratch("feed-ck")
    schema = parts[0].schema
    for part in parts:
        part.write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").format(fmt).save(source)
        drain(start(streams.files(t.spark, source, schema, fmt, bytes_per_batch=BATCH), checkpoint))


def silver_table(t: Tables, name: str = "silver", order=("ts", "ingest_rank"), indexed: bool = False) -> Keyed:
    return Keyed(t.scratch(name), ["event_id"], list(order), ["dt"], t.scratch(f"{name}-index") if indexed else None)


def wire(t: Tables):
    """Order events as an envelope; every 23rd value is malformed, every 19th time is no time."""
    e = F.col("event_id")
    rows = t.events.select(
        e.cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("value").alias("amount"),
        F.when(e % 19 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("event_ts"),
        F.col("event_type").alias("channel"),
        "ts",
        "event_id",
    )
    out = to_envelope(rows, "event_id", "ts", ["order_id", "customer_id", "amount", "event_ts", "channel"])
    key = F.col("key").cast("string").cast("long")
    return out.withColumn("value", F.when(key % 23 == 0, F.lit(b'{"order_id": ')).otherwise(F.col("value")))


WIRE_SQL = """SELECT CASE WHEN event_id % 23 <> 0 THEN CAST(event_id AS VARCHAR) END AS order_id,
    CASE WHEN event_id % 23 <> 0 THEN CAST(user_id AS VARCHAR) END AS customer_id, CASE WHEN event_id % 23 <> 0 THEN value END AS amount,
    CASE WHEN event_id % 23 <> 0 THEN event_type END AS channel, CASE WHEN event_id % 23 <> 0 AND event_id % 19 <> 0 THEN ts END AS event_ts,
    CAST(event_id AS VARCHAR) AS k, ts AS kafka_ts, CASE WHEN event_id % 23 <> 0 AND event_id % 19 <> 0 THEN CAST(ts AS DATE) END AS dt,
    event_id % 23 = 0 OR event_id % 19 = 0 AS is_corrupt FROM events"""


def opened(df):
    parsed = parse_envelope(df, ORDER_EVENT, ingest_ts=ingest())
    return parsed.select(
        "order_id", "customer_id", "amount", "channel", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), "k",
        F.col("kafka_ts").cast("timestamp_ntz").alias("kafka_ts"), "dt", F.col(CORRUPT).isNotNull().alias("is_corrupt"),
    )


@query("str01_envelope_parse", WIRE_SQL)
def _(t):
    return opened(wire(t))


@query("str02_bronze_append", WIRE_SQL)
def _(t):
    path = t.scratch("bronze")
    feed(t, [wire(t)], lambda s, ck: append_stream(opened(s), path, ck, ["channel"]))
    return t.spark.read.parquet(path).withColumn("channel", F.col("channel").cast("string"))


@query("str02_bronze_two_levels", "SELECT event_id, event_type, CAST(ts AS DATE) AS dt, value FROM events")
def _(t):
    """Bronze by day and type."""
    path = t.scratch("bronze-two")
    rows = t.events.select("event_id", "event_type", F.to_date("ts").alias("dt"), "value")
    feed(t, [rows], lambda s, ck: append_stream(s, path, ck, ["dt", "event_type"]))
    return read_if_any(t.spark, path, ["dt", "event_type"], rows.schema)


@query("str03_watermark", "SELECT event_id, ts FROM events")
def _(t):
    """Every event sent twice in one batch, the copies told apart by an offset that spreads them over the state."""
    rows = t.events.select("event_id", "ts")
    twice = rows.withColumn("offset", F.lit(1)).unionAll(rows.withColumn("offset", F.lit(2)))
    path = t.scratch("watermark")

    def start(s, ck):
        return append_stream(dedup.first_per_key(s, ["event_id"], "ts", SPAN, spread=F.pmod("offset", F.lit(16))), path, ck)

    feed(t, [twice], start)
    return t.spark.read.parquet(path).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("str04_dedup_by_key", "SELECT event_id, value, ts FROM events")
def _(t):
    """The first arrival stays: later corrections of the same key do not get through."""
    keep = ["event_id", "value", "ts"]
    path = t.scratch("dedup-key")
    feed(t, [t.events.select(*keep), corrected(t).select(*keep)], lambda s, ck: append_stream(dedup.first_per_key(s, ["event_id"], "ts", SPAN), path, ck))
    return t.spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "str05_dedup_by_key_and_time",
    "SELECT event_id, ts FROM events UNION SELECT event_id, ts + INTERVAL 1 HOUR FROM events WHERE event_id % 7 = 0",
)
def _(t):
    """Copies of the same event go, corrections with another event time stay."""
    rows, fixes = t.events.select("event_id", "ts"), corrected(t).select("event_id", "ts")
    path = t.scratch("dedup-event")
    again = fixes.unionAll(rows.filter("event_id % 5 = 0"))
    feed(t, [rows, again], lambda s, ck: append_stream(dedup.distinct_events(s, ["event_id"], "ts", SPAN), path, ck))
    return t.spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "str06_late_data",
    """SELECT event_id, ts, CAST(ts AS DATE) AS dt FROM events, (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 3 DAY AS mark FROM events WHERE event_id % 6 <> 0)
       WHERE event_id % 6 <> 0 OR ts > mark""",
)
def _(t):
    """Every sixth event comes last. Rows behind the watermark are dropped, the others land in their own day.

    The others come in order of their time, in parts no longer than the delay: so none of
    them is late, however many micro-batches a part is cut into.
    """
    rows = t.events.select("event_id", "ts")
    first, last = rows.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    days = F.datediff(F.to_date("ts"), F.lit(first))
    parts = [rows.filter((F.col("event_id") % 6 != 0) & (F.floor(days / 3) == i)) for i in range((last - first).days // 3 + 1)]
    path = t.scratch("late")

    def start(s, ck):
        kept = dedup.first_per_key(s, ["event_id"], "ts", "3 days")
        return append_stream(kept.withColumn("dt", F.to_date("ts")), path, ck, ["dt"])

    feed(t, [*parts, rows.filter("event_id % 6 = 0")], start)
    return t.spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "str06_late_kept_aside",
    """SELECT event_id, ts, event_id % 6 = 0 AND ts < mark AS late,
        CASE WHEN event_id % 6 = 0 AND ts < mark THEN CAST(epoch_us(mark) - epoch_us(ts) AS DOUBLE) / CAST(1000000 AS DOUBLE) END AS late_by_seconds
       FROM events, (SELECT max(ts) - INTERVAL 3 DAY AS mark FROM events WHERE event_id % 6 <> 0)""",
)
def _(t):
    """Every sixth event comes last, as in `str06_late_data`; what is behind the watermark is kept aside with its delay."""
    rows, accepted = t.events.select("event_id", "ts"), t.scratch("accepted")

    def sink(df, batch_id):
        df.write.mode("overwrite").parquet(f"{accepted}/batch_id={batch_id}")

    split = LateSplit("ts", 3 * 86_400, t.scratch("notes"), t.scratch("aside"), sink)
    feed(t, [rows.filter("event_id % 6 <> 0"), rows.filter("event_id % 6 = 0")], lambda s, ck: batch_stream(s, split, ck))
    kept = t.spark.read.parquet(accepted).select("event_id", "ts", F.lit(False).alias("late"), F.lit(None).cast("double").alias(DELAY))
    return kept.unionByName(split.late_rows(t.spark).select("event_id", "ts", F.lit(True).alias("late"), DELAY))


@query("str07_silver_upsert", SILVER_SQL)
def _(t):
    """Bad rows split off, newest version per key; a correction past midnight moves its key to the next day."""
    table = silver_table(t)
    sink = Upsert(table, rules(), run_log=t.scratch("runs"), registry=t.scratch("registry"), quarantine_path=t.scratch("quarantine"))
    feed(t, [dirty(t), corrected(t)], lambda s, ck: batch_stream(s, sink, ck))
    return t.spark.read.parquet(table.path).select(*SILVER_COLUMNS)


@query("str07_indexed_upsert", SILVER_SQL)
def _(t):
    """The same by an index of the keys: a micro-batch reads its keys' buckets and the days that these name."""
    table = silver_table(t, indexed=True)
    sink = Upsert(table, rules(), run_log=t.scratch("runs"), registry=t.scratch("registry"), quarantine_path=t.scratch("quarantine"))
    feed(t, [dirty(t), corrected(t)], lambda s, ck: batch_stream(s, sink, ck))
    return t.spark.read.parquet(table.path).select(*SILVER_COLUMNS)


@query("str08_silver_upsert_json", SILVER_SQL)
def _(t):
    """JSON Bronze with times as text; types are set inside the batch, ingest order comes first."""
    table = silver_table(t, order=("ingest_rank", "ts"))

    def typed(batch):
        return clean(batch, "ts", ["event_id"], ingest()).withColumns({"ts": F.col("ts").cast("timestamp_ntz"), "value": F.col("value").cast("double")})

    as_text = [p.drop("dt").withColumns({"ts": F.col("ts").cast("string"), "value": F.col("value").cast("string")}) for p in (dirty(t), corrected(t))]
    feed(t, as_text, lambda s, ck: batch_stream(s, Upsert(table, rules(), normalise=typed), ck), "json")
    return t.spark.read.parquet(table.path).select(*SILVER_COLUMNS)


@query(
    "str09_merge_in_partition",
    f"""SELECT event_id, user_id, event_type, value, ts, CAST(ts AS DATE) AS dt FROM (SELECT * FROM ({DIRTY_SQL}) UNION ALL
        SELECT event_id, user_id, event_type, value + 1, ts, 2 FROM events WHERE event_id % 7 = 0) WHERE {VALID}
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, ingest_rank DESC) = 1""",
)
def _(t):
    """Corrections keep their day, so only the partitions of the batch are read."""
    table = silver_table(t)
    same_day = corrected(t).withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 HOUR")).withColumn("dt", F.to_date("ts"))
    sink = Upsert(table, rules(), key_stays_in_partition=True)
    feed(t, [dirty(t), same_day], lambda s, ck: batch_stream(s, sink, ck))
    return t.spark.read.parquet(table.path).select(*SILVER_COLUMNS)


@query("str10_replayed_batch", SILVER_SQL)
def _(t):
    """The same batches handed over again, as after a crash between write and commit: nothing changes."""
    table = silver_table(t)
    sink = Upsert(table, rules())
    for batch_id, batch in enumerate((dirty(t), dirty(t), corrected(t), corrected(t), dirty(t))):
        sink(batch, batch_id)
    return t.spark.read.parquet(table.path).select(*SILVER_COLUMNS)


@query("str10_staged_swap", SILVER_SQL)
def _(t):
    """Days are published by switching the catalog to rows written beside the table; a wrong batch is switched back to its backup."""
    good = split_rules(dirty(t), rules())[0]
    schema = good.schema
    table = StagedTable(f"staged_{uuid.uuid4().hex}", t.scratch("staged"), schema, ["dt"]).create(t.spark)
    first = latest(good, ["event_id"], ["ts", "ingest_rank"])
    table.publish(first, partition_values(first, ["dt"]))
    update = split_rules(corrected(t), rules())[0]
    # A correction may move an event to the next day: the days that hold its key are rewritten with the days of the update.
    held = same_key(table.read(t.spark), update, ["event_id"], "left_semi").select("dt")
    days = partition_values(held.unionByName(update.select("dt")), ["dt"])
    merged = merge_versions(table.read(t.spark).filter(in_partitions(days)), update, ["event_id"], ["ts", "ingest_rank"])
    table.publish(merged, days)
    table.publish(table.read(t.spark).withColumn("value", -F.col("value")), days)
    table.restore(t.spark, days)
    return table.read(t.spark).select(*SILVER_COLUMNS)


@query(
    "str11_clean_stream",
    "SELECT event_id, user_id, value, ts, CAST(ts AS DATE) AS dt FROM (" + DIRTY_SQL + ") WHERE user_id IS NOT NULL AND ts IS NOT NULL",
)
def _(t):
    path = t.scratch("clean")
    raw = dirty(t).select("event_id", "user_id", "value", F.col("ts").cast("string").alias("ts"))
    feed(t, [raw], lambda s, ck: append_stream(clean(s, "ts", ["event_id", "user_id"], ingest()), path, ck, ["dt"]))
    return t.spark.read.parquet(path).select("event_id", "user_id", "value", F.col("ts").cast("timestamp_ntz").alias("ts"), "dt")


@query(
    "str12_two_sinks",
    f"""SELECT 'raw' AS layer, count(*) AS n_rows, count(DISTINCT (event_id, ingest_rank)) AS n_hashes FROM ({DIRTY_SQL} UNION ALL {CORRECTED_SQL})
        UNION ALL SELECT 'silver', count(*), count(*) FROM ({SILVER_SQL})""",
)
def _(t):
    table, raw = silver_table(t), t.scratch("raw")
    sink = raw_and_clean(raw, Upsert(table, rules()), ["event_id", "user_id", "event_type", "value", "ts", "ingest_rank"])
    feed(t, [dirty(t), corrected(t)], lambda s, ck: batch_stream(s, sink, ck))
    bronze = t.spark.read.parquet(raw).groupBy("event_hash").agg(F.count(F.lit(1)).alias("n"))
    top = bronze.agg(F.lit("raw").alias("layer"), F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_hashes"))
    silver = t.spark.read.parquet(table.path)
    hashed = silver.select(row_hash(["event_id", "ts"]).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    return top.unionByName(hashed.agg(F.lit("silver").alias("layer"), F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_hashes")))


@query("str13_restart", SILVER_SQL)
def _(t):
    """Five parts, the query stopped after each; the checkpoint and the idempotent merge give the same table."""
    table = silver_table(t, indexed=True)
    rows = dirty(t)
    parts = [rows.filter(F.pmod("event_id", F.lit(4)) == i) for i in range(4)] + [corrected(t)]
    feed(t, parts, lambda s, ck: batch_stream(s, Upsert(table, rules(), run_log=t.scratch("runs")), ck))
    return t.spark.read.parquet(table.path).select(*SILVER_COLUMNS)


@query(
    "str14_triggers",
    "SELECT v.trigger, count(*) AS n_rows, sum(event_id) ::BIGINT AS id_sum FROM events, (VALUES ('available_now'), ('1 second'), ('default')) v(trigger) GROUP BY 1",
)
def _(t):
    """The same stream under each trigger; the open-ended ones are stopped when all input is processed."""
    source = t.scratch("trigger-src")
    t.events.select("event_id").write.parquet(source)
    out = None
    for trigger in ("available_now", "1 second", "default"):
        path = t.scratch("trigger")
        q = append_stream(streams.like_static(t.spark, source), path, t.scratch("trigger-ck"), trigger=trigger)
        if trigger == "available_now":
            drain(q)
        else:
            q.processAllAvailable()
            q.stop()
        part = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("id_sum"))
        part = part.withColumn("trigger", F.lit(trigger))
        out = part if out is None else out.unionByName(part)
    return out


CHANGES_SQL = """SELECT event_id, value, ts, CASE WHEN event_id % 11 = 0 THEN 'D' ELSE 'U' END AS op, 2 AS seq FROM events WHERE event_id % 11 = 0 OR event_id % 7 = 0
    UNION ALL SELECT event_id, value + 5, ts, 'U', 3 FROM events WHERE event_id % 22 = 0 UNION ALL SELECT event_id, value, ts, 'D', 4 FROM events WHERE event_id % 77 = 0"""


@query(
    "str15_change_events",
    f"""WITH last AS (SELECT * FROM ({CHANGES_SQL}) QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY seq DESC) = 1)
        SELECT event_id, value FROM events WHERE event_id NOT IN (SELECT event_id FROM last) UNION ALL SELECT event_id, value FROM last WHERE op <> 'D'""",
)
def _(t):
    """Updates, deletes, an update after a delete and a delete after that; a deleted key leaves the table."""
    e = F.col("event_id")
    base = t.events.select("event_id", "value")
    first = base.filter((e % 11 == 0) | (e % 7 == 0)).withColumns({"op": F.when(e % 11 == 0, "D").otherwise("U"), "seq": F.lit(2)})
    again = base.filter(e % 22 == 0).withColumns({"value": F.col("value") + 5, "op": F.lit("U"), "seq": F.lit(3)})
    gone = base.filter(e % 77 == 0).withColumns({"op": F.lit("D"), "seq": F.lit(4)})
    return apply_changes(base, first.unionByName(again).unionByName(gone), ["event_id"], ["seq"])


@query(
    "str15_change_stream",
    "WITH c AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'D' END AS op FROM events) SELECT event_id, user_id, value, CAST(ts AS DATE) AS dt FROM events JOIN c USING (event_id) WHERE op IS NULL",
)
def _(t):
    """The same as a stream of changes onto a table: inserts first, then deletes that empty whole keys."""
    e = F.col("event_id")
    rows = t.events.select("event_id", "user_id", "value", F.to_date("ts").alias("dt"))
    inserts = rows.withColumns({"op": F.lit("I"), "seq": F.lit(1)})
    deletes = rows.filter(e % 11 == 0).withColumns({"op": F.lit("D"), "seq": F.lit(2)})
    table = Keyed(t.scratch("cdc"), ["event_id"], ["seq"], ["dt"])
    sink = Upsert(table, not_null_rules(["event_id", "dt"]), deleted=F.col("op") == "D")
    feed(t, [inserts, deletes], lambda s, ck: batch_stream(s, sink, ck))
    return t.spark.read.parquet(table.path).select("event_id", "user_id", "value", "dt")


@query(
    "str15_late_after_delete",
    "SELECT event_id, user_id, CASE WHEN event_id % 22 = 0 THEN value + 9 ELSE value END AS value, CAST(ts AS DATE) AS dt FROM events WHERE event_id % 11 <> 0 OR event_id % 22 = 0",
)
def _(t):
    """Deletes come before the rows that they delete: tombstones keep these out over several batches, newer versions come back."""
    e = F.col("event_id")
    rows = t.events.select("event_id", "user_id", "value", F.to_date("ts").alias("dt"))
    deletes = rows.filter(e % 11 == 0).withColumns({"op": F.lit("D"), "seq": F.lit(5)})
    inserts = rows.withColumns({"op": F.lit("I"), "seq": F.lit(1)})
    updates = rows.filter(e % 33 == 0).withColumns({"value": F.col("value") + 1, "op": F.lit("U"), "seq": F.lit(3)})
    back = rows.filter(e % 22 == 0).withColumns({"value": F.col("value") + 9, "op": F.lit("I"), "seq": F.lit(6)})
    table = Keyed(t.scratch("cdc"), ["event_id"], ["seq"], ["dt"], t.scratch("cdc-index"))
    sink = Upsert(table, not_null_rules(["event_id", "dt"]), deleted=F.col("op") == "D")
    feed(t, [deletes, inserts, back, updates], lambda s, ck: batch_stream(s, sink, ck))
    return t.spark.read.parquet(table.path).select("event_id", "user_id", "value", "dt")


@query(
    "str16_gold_refresh",
    f"SELECT dt, event_type, count(*) AS txns, {sum_sql('value')} AS total_amount, {avg_sql('value')} AS avg_amount FROM ({SILVER_SQL}) GROUP BY dt, event_type",
)
def _(t):
    """Gold is recomputed for the days a batch touched and for no others."""
    gold = t.scratch("gold")
    refresh = gold_refresh(gold, ["dt"], lambda silver: kpi(silver, ["dt", "event_type"], "value"))
    sink = Upsert(silver_table(t), rules(), run_log=t.scratch("runs"), gold=refresh)
    feed(t, [dirty(t), corrected(t)], lambda s, ck: batch_stream(s, sink, ck))
    return t.spark.read.parquet(gold)


@query(
    "str16_gold_by_changes",
    f"""SELECT dt, event_type, count(*) AS txns, {sum_sql('value')} AS total_amount, {avg_sql('value')} AS avg_amount, min(value) AS min_amount,
        max(value) AS max_amount FROM ({SILVER_SQL}) GROUP BY dt, event_type""",
)
def _(t):
    """Old versions are taken off Gold and new ones added; Silver is read again only where a least or greatest amount left."""
    gold = ChangeGold(t.scratch("gold"), ["dt", "event_type"], ["dt"], "value")
    sink = Upsert(silver_table(t, indexed=True), rules(), run_log=t.scratch("runs"), change_gold=gold)
    feed(t, [dirty(t), corrected(t)], lambda s, ck: batch_stream(s, sink, ck))
    return gold.read(t.spark)
