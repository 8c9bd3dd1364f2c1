"""Scalar functions (FUN)."""

import hashlib
import hmac

from pyspark.sql import functions as F

from lakeops.functions.conditional import age_band, amount_bucket
from lakeops.functions.dates import age_on, day_of, parse_event_ts, shift
from lakeops.functions.money import fee
from lakeops.functions.nested import json_rows, map_rows, row_hash
from lakeops.functions.privacy import mask_columns, token
from lakeops.queries.registry import query


@query(
    "fun01_concat",
    "SELECT c_custkey, c_name || '/' || c_mktsegment AS joined, concat_ws('-', c_name, CASE WHEN c_acctbal > 0 THEN c_mktsegment END) AS skipped FROM customer",
)
def _(t):
    return t.customer.select(
        "c_custkey",
        F.concat("c_name", F.lit("/"), "c_mktsegment").alias("joined"),
        F.concat_ws("-", "c_name", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))).alias("skipped"),
    )


@query("fun02_substring_instr", "SELECT c_custkey, substring(c_name, 10, 9) AS number, CAST(instr(c_name, '#') AS INTEGER) AS at FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.substring("c_name", 10, 9).alias("number"), F.instr("c_name", "#").alias("at"))


@query("fun03_regexp_replace", "SELECT doc_id, regexp_replace(text, '[^0-9]', '', 'g') AS digits FROM documents")
def _(t):
    return t.documents.select("doc_id", F.regexp_replace("text", "[^0-9]", "").alias("digits"))


@query("fun04_lower", "SELECT c_custkey, lower(c_name) AS name, lower(c_mktsegment) AS segment FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.lower("c_name").alias("name"), F.lower("c_mktsegment").alias("segment"))


@query(
    "fun05_format_string",
    "SELECT c_custkey, '001' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS id_number, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS nation_code FROM customer",
)
def _(t):
    return t.customer.select(
        "c_custkey",
        F.format_string("001%09d", "c_custkey").alias("id_number"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("nation_code"),
    )


@query(
    "fun06_event_hash",
    "SELECT event_id, sha256(concat_ws('||', CAST(event_id AS VARCHAR), coalesce(CASE WHEN event_id % 13 <> 0 THEN CAST(user_id AS VARCHAR) END, '\\N'), event_type)) AS event_hash FROM events",
)
def _(t):
    rows = t.events.select("event_id", F.when(F.col("event_id") % 13 != 0, F.col("user_id")).alias("user_id"), "event_type")
    return rows.select("event_id", row_hash(["event_id", "user_id", "event_type"]).alias("event_hash"))


@query("fun07_to_date", "SELECT event_id, CAST(ts AS DATE) AS dt FROM events")
def _(t):
    return t.events.select("event_id", day_of("ts").alias("dt"))


@query(
    "fun08_parse_timestamp",
    "SELECT event_id, CASE WHEN event_id % 4 < 3 THEN date_trunc('second', ts) END AS parsed, CASE WHEN event_id % 4 = 0 THEN date_trunc('second', ts) END AS by_pattern FROM events",
)
def _(t):
    """Plain, Z and +07:00 texts and one that is no time; the last gives null, not a failed job."""
    e = F.col("event_id") % 4
    text = (
        F.when(e == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(e == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(e == 2, F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL 7 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00")))
        .otherwise(F.lit("not a time"))
    )
    return t.events.select("event_id", text.alias("x")).select(
        "event_id",
        parse_event_ts("x").cast("timestamp_ntz").alias("parsed"),
        parse_event_ts("x", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz").alias("by_pattern"),
    )


@query(
    "fun09_injected_now",
    "SELECT event_id, TIMESTAMP '2026-01-12 10:00:00' AS ingest_ts, CAST(DATE '2026-01-12' - CAST(ts AS DATE) AS INTEGER) AS days_old FROM events",
)
def _(t):
    """The run's time is a parameter, so a run can be repeated."""
    now = F.lit("2026-01-12 10:00:00").cast("timestamp_ntz")
    return t.events.select("event_id", now.alias("ingest_ts"), F.date_diff(F.to_date(now), F.to_date("ts")).alias("days_old"))


@query(
    "fun10_date_add_sub",
    "SELECT event_id, CAST(ts AS DATE) + CAST(event_id % 30 AS INTEGER) AS later, CAST(ts AS DATE) - CAST(event_id % 365 AS INTEGER) AS earlier FROM events",
)
def _(t):
    n = F.col("event_id")
    return t.events.select(
        "event_id",
        F.date_add(F.to_date("ts"), (n % 30).cast("int")).alias("later"),
        F.date_sub(F.to_date("ts"), (n % 365).cast("int")).alias("earlier"),
    )


@query(
    "fun11_months",
    """SELECT o_orderkey, CAST(d + to_months(CAST(o_orderkey % 24 AS INTEGER)) AS DATE) AS moved,
       CASE WHEN day(d) = day(r) OR (d = last_day(d) AND r = last_day(r)) THEN CAST(m AS DOUBLE)
            ELSE round(m + (day(d) - day(r)) * 86400 / (31 * 86400.0)::DOUBLE, 8) END AS months
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, DATE '1995-02-28' AS r,
             (year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 2 AS m FROM orders)""",
)
def _(t):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.add_months(d, (F.col("o_orderkey") % 24).cast("int")).alias("moved"),
        F.months_between(d, F.lit("1995-02-28").cast("date")).alias("months"),
    )


@query(
    "fun12_intervals",
    "SELECT event_id, ts - to_days(CAST(event_id % 30 AS INTEGER)) AS back, ts + to_days(1) + to_hours(event_id % 5) + to_minutes(event_id % 60) AS ahead, ts + INTERVAL 90 MINUTE AS fixed FROM events",
)
def _(t):
    n = F.col("event_id")
    return t.events.select(
        "event_id",
        shift("ts", days=-(n % 30)).alias("back"),
        shift("ts", days=1, hours=n % 5, mins=n % 60).alias("ahead"),
        F.timestamp_add("MINUTE", F.lit(90), "ts").alias("fixed"),
    )


@query(
    "fun13_age_band",
    """SELECT c_custkey, age, CASE WHEN age < 25 THEN 'Gen Z' WHEN age < 41 THEN 'Millennials' WHEN age < 56 THEN 'Gen X' ELSE 'Boomers' END AS band
       FROM (SELECT c_custkey, CAST(2026 - year(DATE '2008-01-01' - CAST((c_custkey * 31) % 18000 AS INTEGER)) AS INTEGER) AS age FROM customer)""",
)
def _(t):
    birth = F.date_sub(F.lit("2008-01-01").cast("date"), (F.col("c_custkey") * 31 % 18000).cast("int"))
    aged = t.customer.select("c_custkey", age_on(birth, F.lit("2026-01-01").cast("date")).alias("age"))
    return aged.withColumn("band", age_band("age"))


@query(
    "fun14_arithmetic",
    """SELECT o_orderkey, CAST((((o_orderkey - 7000) % 5) + 5) % 5 AS BIGINT) AS wrapped, CAST((o_orderkey - 7000) % 5 AS BIGINT) AS remainder,
       CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands, round(o_totalprice) AS whole FROM orders""",
)
def _(t):
    k = F.col("o_orderkey") - 7000
    return t.orders.select(
        "o_orderkey",
        F.pmod(k, F.lit(5)).alias("wrapped"),
        (k % 5).alias("remainder"),
        F.floor(F.col("o_totalprice") / 1000).alias("thousands"),
        F.round("o_totalprice").alias("whole"),
    )


@query(
    "fun16_banding",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice < 1000 THEN 'LOW' WHEN l_extendedprice < 3000 THEN 'MID' ELSE 'HIGH' END AS bucket FROM lineitem",
)
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", amount_bucket("l_extendedprice").alias("bucket"))


@query(
    "fun17_coalesce_nullif",
    "SELECT event_id, coalesce(nullif(event_type, 'error'), 'none') AS kind, nullif(user_id, 7) AS user_or_null FROM events",
)
def _(t):
    return t.events.select(
        "event_id",
        F.coalesce(F.nullif("event_type", F.lit("error")), F.lit("none")).alias("kind"),
        F.nullif("user_id", F.lit(7)).alias("user_or_null"),
    )


@query(
    "fun18_casts",
    """SELECT event_id, TRY_CAST(x AS BIGINT) AS as_long, TRY_CAST(x AS DOUBLE) AS as_double, x AS as_text, CAST(value AS INTEGER) AS rounded_in
       FROM (SELECT event_id, floor(value) AS value, CASE event_id % 3 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN 'x' || event_id ELSE NULL END AS x FROM events)""",
)
def _(t):
    e = F.col("event_id")
    text = F.when(e % 3 == 0, e.cast("string")).when(e % 3 == 1, F.concat(F.lit("x"), e.cast("string")))
    return t.events.select("event_id", F.floor("value").alias("v"), text.alias("x")).select(
        "event_id",
        F.col("x").try_cast("long").alias("as_long"),
        F.col("x").try_cast("double").alias("as_double"),
        F.col("x").cast("binary").cast("string").alias("as_text"),
        F.col("v").cast("int").alias("rounded_in"),
    )


@query(
    "fun19_element_at",
    "SELECT event_id, ['POS','ECOM','ATM'][CAST(event_id % 3 AS INTEGER) + 1] AS channel, ['a','b'][CAST(event_id % 3 AS INTEGER) + 1] AS may_lack FROM events",
)
def _(t):
    at = (F.col("event_id") % 3 + 1).cast("int")
    return t.events.select(
        "event_id",
        F.element_at(F.array(F.lit("POS"), F.lit("ECOM"), F.lit("ATM")), at).alias("channel"),
        F.try_element_at(F.array(F.lit("a"), F.lit("b")), at).alias("may_lack"),
    )


@query(
    "fun20_sequence_explode",
    "SELECT l_orderkey, l_linenumber, unnest(range(0, CAST(l_quantity AS BIGINT) % 4)) AS unit FROM lineitem",
)
def _(t):
    n = F.col("l_quantity").cast("long") % 4
    units = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.explode(units).alias("unit"))


@query(
    "fun21_explode_map",
    "SELECT event_id, 'value' AS k, CAST(value AS DOUBLE) AS v FROM events UNION ALL SELECT event_id, 'user', CAST(user_id AS DOUBLE) FROM events",
)
def _(t):
    rows = t.events.select(
        "event_id", F.create_map(F.lit("value"), F.col("value"), F.lit("user"), F.col("user_id").cast("double")).alias("m")
    )
    return map_rows(rows, "m")


@query(
    "fun22_json_fields",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.k') AS k_text, json_extract_string(props, '$.none') AS missing FROM events",
)
def _(t):
    return t.events.select(
        "event_id",
        F.from_json("props", "k int")["k"].alias("k"),
        F.get_json_object("props", "$.k").alias("k_text"),
        F.get_json_object("props", "$.none").alias("missing"),
    )


@query(
    "fun23_json_table",
    "SELECT o_orderkey, i AS line, 'item' || i AS sku FROM orders, (SELECT unnest(range(1, 4)) AS i) WHERE i <= o_orderkey % 3 + 1",
)
def _(t):
    """A JSON array of one to three lines per order, opened into rows."""
    n = (F.col("o_orderkey") % 3 + 1).cast("long")
    lines = F.transform(
        F.sequence(F.lit(1).cast("long"), n),
        lambda i: F.struct(i.alias("line"), F.concat(F.lit("item"), i.cast("string")).alias("sku")),
    )
    return json_rows(t.orders.select("o_orderkey", F.to_json(lines).alias("j")), "j", "line: bigint, sku: string")


@query("fun24_fee", "SELECT event_id, CAST(round(CAST(CAST(value * CAST(0.015 AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE) AS fee, value * CAST(0.01 AS DOUBLE) AS flat_fee FROM events")
def _(t):
    return t.events.select("event_id", fee("value", 0.015).alias("fee"), (F.col("value") * 0.01).alias("flat_fee"))


@query(
    "fun25_masking",
    r"""SELECT doc_id, regexp_replace(text, '([A-Za-z0-9])[A-Za-z0-9._%+-]*@([A-Za-z0-9.-]+)', '\1***@\2', 'g') AS text,
        regexp_replace(regexp_replace(regexp_replace(who, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS who,
        '*** *** ' || right(phone, 3) AS phone, '##-** ****' AS address FROM
        (SELECT doc_id, text, 'Customer#' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS who, '091 234 ' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') AS phone FROM documents)""",
)
def _(t):
    rows = t.documents.select(
        "doc_id",
        "text",
        F.format_string("Customer#%09d", "doc_id").alias("who"),
        F.format_string("091 234 %03d", F.col("doc_id") % 1000).alias("phone"),
        F.lit("12-Lê LoiX").alias("address"),
    )
    return mask_columns(rows, {"text": "email", "who": "name", "phone": "phone", "address": "address"})


SECRET = b"test key, not a secret"


@query(
    "fun26_tokens",
    "SELECT c_custkey, sha256(unhex('{o}') || unhex(sha256(unhex('{i}') || encode(c_name)))) AS token FROM customer".format(
        o=bytes(b ^ 0x5C for b in SECRET.ljust(64, b"\0")).hex(), i=bytes(b ^ 0x36 for b in SECRET.ljust(64, b"\0")).hex()
    ),
)
def _(t):
    return t.customer.select("c_custkey", token("c_name", SECRET).alias("token"))


def reference_token(value: str) -> str:
    """The token by the standard library, for tests."""
    return hmac.new(SECRET, value.encode(), hashlib.sha256).hexdigest()
