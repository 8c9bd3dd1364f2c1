"""Column expressions: hashes, tokens, masks, times, bands."""

import pytest
from pyspark.sql import functions as F

from lakeops.functions.conditional import amount_bucket
from lakeops.functions.dates import parse_event_ts
from lakeops.functions.money import exact_avg, exact_sum
from lakeops.functions.nested import json_rows, row_hash
from lakeops.functions.privacy import mask_columns, token
from lakeops.queries.functions import SECRET, reference_token


def one(df, column):
    return df.select(column.alias("x")).first()["x"]


def test_token_is_hmac_and_joins(spark, tables):
    df = spark.createDataFrame([("Nguyễn",), ("",), (None,)], "s string").select("s", token("s", SECRET).alias("t"))
    got = {r["s"]: r["t"] for r in df.collect()}
    assert got["Nguyễn"] == reference_token("Nguyễn") and got[""] == reference_token("") and got[None] is None
    long = spark.createDataFrame([("x",)], "s string").select(token("s", b"k" * 100).alias("t")).first()["t"]
    import hashlib, hmac  # noqa: E401

    assert long == hmac.new(b"k" * 100, b"x", hashlib.sha256).hexdigest()
    names = tables.customer.select("c_name", token("c_name", SECRET).alias("t"))
    other = tables.customer.select(F.col("c_name").alias("n"), token("c_name", SECRET).alias("t"))
    joined = names.join(other, "t")
    assert joined.count() == tables.customer.count() and joined.filter("c_name <> n").isEmpty()


def test_row_hash_tells_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "")], "p string, q string")
    assert df.select(row_hash(["p", "q"]).alias("h")).distinct().count() == 3


def test_masks(spark):
    df = spark.createDataFrame([("An Lê 7", "an.le@bank.vn and x@y.io", "+84 912 345 678", "12 Lê Lợi")], "n string, e string, p string, a string")
    out = mask_columns(df, {"n": "name", "e": "email", "p": "phone", "a": "address"}).first()
    assert out[:] == ("Xx Xx n", "a***@bank.vn and x***@y.io", "+** *** *** 678", "## ** ***")
    with pytest.raises(ValueError):
        mask_columns(df, {"n": "iris"})


@pytest.mark.parametrize(
    ("text", "want"),
    [("2026-01-12 10:00:00", "10:00:00"), ("2026-01-12T10:00:00Z", "10:00:00"), ("2026-01-12T10:00:00+07:00", "03:00:00"), ("soon", None), (None, None)],
)
def test_times(spark, text, want):
    df = spark.createDataFrame([(text,)], "s string")
    got = one(df, F.date_format(parse_event_ts("s"), "HH:mm:ss"))
    assert got == want


def test_quoted_zone_is_refused(spark):
    with pytest.raises(ValueError):
        parse_event_ts("s", "yyyy-MM-dd'T'HH:mm:ss'Z'")


def test_bands_and_sums(spark):
    df = spark.createDataFrame([(999.99,), (1000.0,), (3000.0,), (None,)], "v double")
    assert [r[0] for r in df.select(amount_bucket("v")).collect()] == ["LOW", "MID", "HIGH", None]
    tenths = spark.range(1000).select(F.lit(0.1).alias("v"))
    assert tenths.agg(exact_sum("v")).first()[0] == 100.0
    assert df.agg(exact_avg("v", 2)).first()[0] == pytest.approx(4999.99 / 3)
    assert df.filter("v is null").agg(exact_avg("v")).first()[0] is None


def test_json_rows_outer_keeps_malformed(spark):
    df = spark.createDataFrame([(1, '[{"a": 1}, {"a": 2}]'), (2, "[]"), (3, "{oops"), (4, None)], "id int, j string")
    assert json_rows(df, "j", "a: int").count() == 2
    assert json_rows(df, "j", "a: int", outer=True).count() == 5
