"""Pricing summary: DuckDB oracle, Python brute force, skew, edge cases."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF_ORACLE, SF_SMALL, duckdb_with_views
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillandsia.plans.pricing import PRICING_SUMMARY_SQL, pricing_summary, pricing_summary_of
from tillandsia.sources.tables import table_path

CENT = Decimal("0.01")
COLUMNS = ["l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"]
LINEITEM_SCHEMA = T.StructType(
    [
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
    ]
)


def to_cents(x: float) -> Decimal:
    """Round a double the way a cast to decimal(p,2) does (HALF_UP)."""
    return Decimal(repr(x)).quantize(CENT, rounding=ROUND_HALF_UP)


def brute_force(rows, cutoff: str) -> list[tuple]:
    """Row-by-row pricing summary in Python decimals: the independent oracle."""
    limit = dt.datetime.fromisoformat(cutoff) + dt.timedelta(days=1)
    acc = defaultdict(lambda: [Decimal(0), Decimal(0), 0])
    for price, discount, flag, status, shipdate in rows:
        if shipdate < limit:
            p, d = to_cents(price), to_cents(discount)
            a = acc[(flag, status)]
            a[0] += p
            a[1] += p * (1 - d)
            a[2] += 1
    return sorted((k[0], k[1], v[0], v[1], v[2]) for k, v in acc.items())


def lineitem_rows(sf_dir: str) -> list[tuple]:
    table = pq.read_table(table_path(sf_dir, "lineitem"), columns=COLUMNS)
    return list(zip(*(table.column(c).to_pylist() for c in COLUMNS)))


def as_tuples(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
def test_matches_duckdb_oracle(spark, sf_dir):
    con = duckdb_with_views(sf_dir)
    expected = sorted(con.execute(PRICING_SUMMARY_SQL).fetchall())
    got = as_tuples(pricing_summary(spark, sf_dir))
    assert got == expected  # Spark output is already ordered by the keys


def test_oracle_sql_gives_same_result_on_spark_sql(spark):
    spark.read.parquet(table_path(SF_ORACLE, "lineitem")).createOrReplaceTempView("lineitem")
    assert as_tuples(spark.sql(PRICING_SUMMARY_SQL)) == as_tuples(pricing_summary(spark, SF_ORACLE))


@pytest.mark.parametrize(
    "cutoff",
    # Before the first ship day, a day inside the data, the
    # default cutoff, and the last ship day.
    ["1995-01-01", "1997-03-15", "1998-09-02", "2001-11-04"],
)
def test_matches_brute_force_on_whole_table(spark, cutoff):
    rows = lineitem_rows(SF_ORACLE)
    got = as_tuples(pricing_summary(spark, SF_ORACLE, ship_cutoff=cutoff))
    assert got == brute_force(rows, cutoff)


def test_whole_cutoff_day_is_included(spark):
    day = dt.datetime(1998, 9, 2)
    rows = [
        (10.0, 0.0, "A", "F", day),
        (20.0, 0.0, "A", "F", day + dt.timedelta(hours=12)),
        (40.0, 0.0, "A", "F", day + dt.timedelta(days=1, microseconds=-1)),
        (80.0, 0.0, "A", "F", day + dt.timedelta(days=1)),
    ]
    df = spark.createDataFrame(rows, LINEITEM_SCHEMA)
    want = [("A", "F", Decimal("70.00"), Decimal("70.0000"), 3)]
    assert as_tuples(pricing_summary_of(df)) == want == brute_force(rows, "1998-09-02")
    df.createOrReplaceTempView("lineitem")
    assert as_tuples(spark.sql(PRICING_SUMMARY_SQL)) == want
    con = duckdb.connect()
    con.register("lineitem", pa.Table.from_pylist([dict(zip(COLUMNS, r)) for r in rows]))
    assert con.execute(PRICING_SUMMARY_SQL).fetchall() == want


def test_ship_dates_of_type_date_are_accepted(spark):
    rows = [(10.0, 0.0, "A", "F", dt.date(1998, 9, d)) for d in (1, 2, 3)]
    schema = T.StructType([*LINEITEM_SCHEMA.fields[:4], T.StructField("l_shipdate", T.DateType())])
    got = as_tuples(pricing_summary_of(spark.createDataFrame(rows, schema)))
    assert got == [("A", "F", Decimal("20.00"), Decimal("20.0000"), 2)]


@pytest.mark.parametrize("kind", ["timestamp", "string", "bigint"])
def test_ship_dates_of_other_types_are_refused(spark, kind):
    df = spark.createDataFrame([], LINEITEM_SCHEMA).withColumn("l_shipdate", F.lit(None).cast(kind))
    with pytest.raises(TypeError, match="timestamp_ntz or date"):
        pricing_summary_of(df)


@pytest.mark.parametrize("tz", ["UTC", "America/Los_Angeles", "Asia/Kolkata", "Pacific/Kiritimati"])
def test_result_does_not_depend_on_session_time_zone(spark, tz):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", tz)
        got = as_tuples(pricing_summary(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == brute_force(lineitem_rows(SF_SMALL), "1998-09-02")


def test_hot_group_holding_most_rows(spark):
    """One (flag, status) group repeated until it holds over half the rows."""
    base = spark.read.parquet(table_path(SF_SMALL, "lineitem"))
    hot = base.where("l_returnflag = 'N' AND l_linestatus = 'F'")
    skewed = base
    for _ in range(8):
        skewed = skewed.unionByName(hot)
    skewed = skewed.repartition(16)  # spread the hot group over many map tasks
    rows = lineitem_rows(SF_SMALL)
    hot_rows = [r for r in rows if r[2] == "N" and r[3] == "F"]
    all_rows = rows + hot_rows * 8
    assert 3 * len([r for r in all_rows if r[2] == "N" and r[3] == "F"]) > len(all_rows)
    got = as_tuples(pricing_summary_of(skewed.select(*COLUMNS)))
    assert got == brute_force(all_rows, "1998-09-02")


row_strategy = st.tuples(
    st.integers(min_value=0, max_value=10**10 - 1).map(lambda c: c / 100),  # fits decimal(12,2)
    st.integers(min_value=-9999, max_value=9999).map(lambda c: c / 100),  # fits decimal(4,2)
    st.sampled_from("ANR"),
    st.sampled_from("FO"),
    st.datetimes(min_value=dt.datetime(1998, 8, 30), max_value=dt.datetime(1998, 9, 5)),
)


@settings(
    max_examples=25,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(rows=st.lists(row_strategy, min_size=0, max_size=60))
def test_aggregation_is_exact_for_any_prices_and_discounts(spark, rows):
    df = spark.createDataFrame(rows, LINEITEM_SCHEMA)
    assert as_tuples(pricing_summary_of(df)) == brute_force(rows, "1998-09-02")


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "bad_row",
    [
        (1e11, 0.0, "A", "F", dt.datetime(1998, 1, 1)),  # price beyond decimal(12,2)
        (10.0, 123.0, "A", "F", dt.datetime(1998, 1, 1)),  # discount beyond decimal(4,2)
    ],
)
def test_value_that_does_not_fit_fails_instead_of_dropping(spark, ansi, bad_row):
    """An overflowing cast must fail the query in either ANSI mode, not vanish as a null."""
    good_row = (10.0, 0.05, "A", "F", dt.datetime(1998, 1, 1))
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        df = pricing_summary_of(spark.createDataFrame([good_row, bad_row], LINEITEM_SCHEMA))
        with pytest.raises(Exception, match="(?i)overflow|cannot be represented|no decimal|OUT_OF_RANGE"):
            df.collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_same_result_in_both_ansi_modes(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        got = as_tuples(pricing_summary(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert got == brute_force(lineitem_rows(SF_SMALL), "1998-09-02")


def plain_cast_result(spark, df):
    """The query as written in SQL, with Spark's own per-row decimal casts."""
    df.createOrReplaceTempView("lineitem")
    return as_tuples(spark.sql(PRICING_SUMMARY_SQL))


def near_rounding_boundaries(max_abs_cents: int):
    """Doubles at and next to a half-cent, where HALF_UP rounding decides."""
    import math

    half = st.integers(min_value=-max_abs_cents, max_value=max_abs_cents).map(lambda c: (c + 0.5) / 100)
    return half.flatmap(
        lambda x: st.sampled_from([x, math.nextafter(x, math.inf), math.nextafter(x, -math.inf)])
    )


def money(max_abs_cents: int):
    bound = (max_abs_cents - 1) / 100
    return st.one_of(
        st.integers(min_value=-max_abs_cents + 1, max_value=max_abs_cents - 1).map(lambda c: c / 100),
        st.floats(min_value=-bound, max_value=bound, allow_nan=False, allow_infinity=False),
        near_rounding_boundaries(max_abs_cents - 2),
        st.sampled_from([0.0, -0.0, 5e-324, -5e-324, 0.005, 0.015, 1.005, 0.125, 2.675]),
    )


any_row = st.tuples(
    money(10**12),  # prices anywhere in decimal(12,2), any fraction
    money(10**4),  # discounts anywhere in decimal(4,2), any fraction
    st.sampled_from("ANR"),
    st.sampled_from("FO"),
    st.datetimes(min_value=dt.datetime(1998, 8, 30), max_value=dt.datetime(1998, 9, 5)),
)


@settings(
    max_examples=40,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(rows=st.lists(any_row, min_size=1, max_size=40))
def test_integer_cents_path_equals_spark_decimal_cast_for_any_doubles(spark, rows):
    df = spark.createDataFrame(rows, LINEITEM_SCHEMA)
    assert as_tuples(pricing_summary_of(df)) == plain_cast_result(spark, df)


@pytest.mark.parametrize(
    "price, discount",
    [
        (-0.0, -0.0),
        (0.125, 0.125),  # exact binary half-cents: HALF_UP goes away from zero
        (-0.125, -0.125),
        (2.675, 0.015),  # decimal strings say half-cent, binary value is just below/above
        (1e-300, 1e-300),
        (99999999.995, 0.045),
        (9999999999.994, 99.994),  # largest values that still round into range
        (None, 0.05),
        (10.0, None),
    ],
)
def test_special_values_match_spark_decimal_cast(spark, price, discount):
    rows = [(price, discount, "A", "F", dt.datetime(1998, 1, 1)), (1.0, 0.01, "A", "F", dt.datetime(1998, 1, 1))]
    df = spark.createDataFrame(rows, LINEITEM_SCHEMA)
    assert as_tuples(pricing_summary_of(df)) == plain_cast_result(spark, df)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("value", [float("nan"), float("inf"), float("-inf"), 9999999999.995])
@pytest.mark.parametrize("column", ["price", "discount"])
def test_values_without_a_decimal_value_fail_the_query(spark, ansi, value, column):
    """Stricter than Spark's cast, which gives NULL for NaN and infinities even under ANSI."""
    price, discount = (value, 0.0) if column == "price" else (1.0, value)
    df = spark.createDataFrame([(price, discount, "A", "F", dt.datetime(1998, 1, 1))], LINEITEM_SCHEMA)
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        with pytest.raises(Exception, match="(?i)overflow|cannot be represented|no decimal|OUT_OF_RANGE"):
            pricing_summary_of(df).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_group_with_only_null_values_gives_null_sums_like_sql(spark):
    day = dt.datetime(1998, 1, 1)
    rows = [(None, None, "A", "F", day), (None, 0.05, "A", "F", day), (5.0, None, "N", "O", day)]
    df = spark.createDataFrame(rows, LINEITEM_SCHEMA)
    got = as_tuples(pricing_summary_of(df))
    assert got == plain_cast_result(spark, df)
    assert got == [("A", "F", None, None, 2), ("N", "O", Decimal("5.00"), None, 1)]
