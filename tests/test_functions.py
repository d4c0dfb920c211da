"""Column expressions against fixed vectors."""

import datetime as dt
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from orderloom.functions import dates, keys, masking, numeric, segments, text
from orderloom.operators import serving

from conftest import values

ID = "861eff4711a542e4b93843c6dd7febb0"
OTHER = "290c77bc529b7ac935b93aa66c333dc3"


def apply(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.select(expression(F.col("v")).alias("x"), "i").orderBy("i").collect()]


def test_customer_pseudonym_is_the_keyed_hash(spark):
    secret = "s3cret"
    got = apply(spark, [ID, OTHER, "", None], lambda c: masking.mask_customer_id(c, secret))
    expected = [
        "cust_" + hmac.new(secret.encode(), i.encode(), hashlib.sha256).hexdigest()[:8]
        for i in (ID, OTHER)
    ]
    assert got == [*expected, "", None]
    assert all(len(g) == 13 for g in got[:2]) and got[0] != got[1]


def test_long_secret_and_more_digits(spark):
    secret = "k" * 100
    got = apply(spark, [ID], lambda c: masking.mask_customer_id(c, secret, 16))
    assert got[0] == "cust_" + hmac.new(
        secret.encode(), ID.encode(), hashlib.sha256).hexdigest()[:16]


@pytest.mark.parametrize("mask, vectors", [
    (masking.mask_email, {
        "john@example.com": "j***@***.com", "user@test.co.uk": "u***@***.uk",
        "user@test.io": "u***@***.io", "notanemail": "***", "": "***", "a@b": "a***@***",
        "@x.org": "***@***.org",
    }),
    (masking.mask_phone, {
        "+1-555-0123": "+1-***-****", "": "***", "555-867-5309": "555-***-****",
        "(11) 99999.0000": "(11) *****.****", "ext 12 34": "ext 12 **",
    }),
    (masking.mask_name, {
        "John": "J***", "John Smith": "J*** S***", "Maria da Silva": "M*** d*** S***",
        "": "***", "  Ana   Lima ": "A*** L***",
    }),
])
def test_partial_masks(spark, mask, vectors):
    assert apply(spark, list(vectors), mask) == list(vectors.values())


def test_mask_columns_changes_only_the_named_ones(spark):
    rows = [(ID, "SP", "sao paulo", 350.0, 4.2), (None, "RJ", "rio", 120.5, 3.8)]
    df = spark.createDataFrame(
        rows, "customer_unique_id string, state string, city string, spend double, score double")
    masked = values(masking.mask_columns(df, masking.default_masks("s")))
    assert masked[0][0].startswith("cust_") and masked[0][1:] == rows[0][1:]
    assert masked[1] == rows[1]
    city = masking.mask_columns(df, {"city": lambda c: F.lit("***"), "absent": lambda c: c})
    assert [r[2] for r in values(city)] == ["***", "***"]
    assert [r[0] for r in values(city)] == [ID, None]
    assert masking.mask_columns(df.limit(0), masking.default_masks("s")).count() == 0


ACCEPTED = ["2017-06-15", "2016-01-01", "2018-12-31", "2016-02-29"]
MALFORMED = [
    "01/01/2016", "01-01-2016", "2016/01/01", "20160101", "2016-1-1", "Jan 1, 2016",
    "2016-13-01", "2016-00-15", "2016-01-00", "2016-01-32", "2016-02-30", "2016-02-31",
    "2017-11-31", "", "not-a-date", "2016", "2016-01",
    "2016-01-01' OR '1'='1", "2016-01-01; DROP TABLE orders; --", "2016-01-01\nOR 1=1",
    "2016-01-01 OR 1=1", "' OR '1'='1", "2016-01-01\n", "2016-W01-1",
]
OUTSIDE = ["2015-12-31", "2019-01-01", "2020-06-15", "1900-01-01", "2099-12-31"]


def test_date_arguments():
    for good in ACCEPTED:
        assert serving.parse_date(good, "start_month") == dt.date.fromisoformat(good)
    for bad in [*MALFORMED, 20160101, None]:
        with pytest.raises(ValueError) as error:
            serving.parse_date(bad, "start_month")
        assert "start_month" in str(error.value)
        assert not bad or str(bad) not in str(error.value)
    for outside in OUTSIDE:
        with pytest.raises(ValueError) as error:
            serving.parse_date(outside, "end_month")
        assert "2016-01-01" in str(error.value) and outside not in str(error.value)


def test_date_column(spark):
    inputs = [*ACCEPTED, *MALFORMED, *OUTSIDE, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    reasons = {r.v: r.rejected_because for r in serving.check_dates(df, "v").collect()}
    assert all(reasons[v] is None for v in ACCEPTED)
    assert all(reasons[v] == "not a valid date" for v in [*MALFORMED, None])
    assert all(reasons[v] == "outside range" for v in OUTSIDE)


def test_rounding_decides_on_decimal_digits(spark):
    got = apply(spark, [1.005, 2.675, -1.005, None], lambda c: numeric.rounded(c, 2), "double")
    assert got == [1.01, 2.68, -1.01, None]


def test_ratio_guards_zero(spark):
    df = spark.createDataFrame([(1, 0), (3, 4), (None, 2)], "a int, b int")
    assert values(df.select(numeric.ratio("a", "b"))) == [(None,), (0.75,), (None,)]


def test_money_sums_are_exact_in_any_order(spark):
    amounts = [0.1, 0.2, 0.7, 1e9 + 0.01, -3.25, 17205.260000000002, None] * 50
    for order in (amounts, amounts[::-1]):
        df = spark.createDataFrame([(a,) for a in order], "a double").repartition(7)
        row = df.agg(numeric.money_sum("a").cast("double").alias("s"),
                     numeric.money_mean("a").alias("m")).first()
        assert row.s == 50_000_860_151.0
        assert row.m == row.s / 300
    none = spark.createDataFrame([(None,)], "a double").agg(numeric.money_sum("a").alias("s"))
    assert none.first().s is None


def test_calendar(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2017-01-01 23:59:59' AS a, "
                   "TIMESTAMP_NTZ'2017-01-03 00:30:00' AS b")
    row = df.select(
        dates.days_between("a", "b"), dates.hours_between("a", "b"), dates.month_start("b"),
        dates.week_start("a"), dates.weekday("a"), dates.days_earlier("b", 90),
        dates.month_label("a"),
    ).first()
    assert row[0] == 2 and abs(row[1] - 24.500277777) < 1e-6
    assert row[2] == dt.datetime(2017, 1, 1) and row[3] == dt.datetime(2016, 12, 26)
    assert row[4] == 0 and row[5] == dt.datetime(2016, 10, 5, 0, 30) and row[6] == "2017-01"


def test_surrogate_key_marks_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", None)], "x string, y int")
    got = [r[0] for r in values(df.select(keys.surrogate_key("x", "y")))]
    sentinel = "_dbt_utils_surrogate_key_null_"
    assert got == [hashlib.md5(t.encode()).hexdigest() for t in ("a-1", f"a-{sentinel}")]


def test_value_at_max_breaks_ties_and_skips_missing_keys(spark):
    df = spark.createDataFrame(
        [("g", "boleto", 5.0, 1), ("g", "voucher", 5.0, 2), ("g", "credit_card", None, 3),
         ("h", "boleto", None, 1)],
        "g string, kind string, value double, seq int")
    got = dict(values(df.groupBy("g").agg(keys.value_at_max("kind", "value", "seq"))))
    assert got == {"g": "voucher", "h": None}


def test_segments(spark):
    assert apply(spark, [1, 2, 4, 5, 0], segments.frequency_segment, "int") == [
        "one_time", "repeat", "repeat", "loyal", "loyal"]
    assert apply(spark, [0, None], lambda c: segments.frequency_segment(c, "none"), "int") == [
        "none", "none"]
    assert apply(spark, [4.0, 3.99, 3.0, 2.9, None], segments.satisfaction_segment, "double") == [
        "satisfied", "neutral", "neutral", "dissatisfied", "dissatisfied"]
    assert apply(spark, [0.85, 0.65, 0.4, 0.39], segments.risk_tier, "double") == [
        "critical", "high", "medium", "low"]
    assert [b[0] for b in apply(spark, [3, 4, 7, 14, 21, 22], segments.delivery_bucket, "int")] \
        == ["1", "2", "2", "3", "4", "5"]
    assert apply(spark, ["low", "critical", "medium"], segments.risk_tier_rank) == [4, 1, 3]
    assert apply(spark, [0.1, -0.3, 0.5, 0.9], segments.effect_label, "double") == [
        "Negligible", "Small", "Medium", "Large"]


def test_log_texts(spark):
    long = "  SELECT *\nFROM t " + "x" * 300
    got = apply(spark, [long], text.preview)[0]
    assert got.startswith("SELECT * FROM t xxx") and len(got) == 198
    df = spark.sql("SELECT map('email', 'a@b.c', 'limit', '5', 'name', 'Ana') AS p")
    assert df.select(text.redacted("p")).first()[0] == {
        "email": "<redacted>", "limit": "5", "name": "<redacted>"}
    assert apply(spark, ["x", "", None], text.has_text) == [True, False, False]
