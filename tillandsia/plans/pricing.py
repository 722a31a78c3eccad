"""Pricing summary over ``lineitem``: the package's one (flagship) query.

rows shipped up to a cutoff day, grouped by return flag and line status,
with the exact decimal sum of prices, of discounted prices, and the row
count.

Plan at scale (check with ``pricing_summary(...).explain("formatted")``):

- Parquet scan reads only the five columns used (``ReadSchema``) and gets the
  cutoff as a pushed filter, so row groups entirely after it are skipped
  from their min/max statistics.
- Per row, only double and ``bigint`` arithmetic. Price and discount become
  exact integer cents (``cents_sql``: the same values as the decimal casts);
  ``price x (1 - discount)`` becomes the exact bigint
  ``price_cents * (100 - discount_cents)`` in units of 0.0001 (below 2**54 in
  absolute value). Both are summed exactly as 14-bit parts in ``bigint`` sums
  (``split_sum_sql``), which cannot overflow below 2**49 rows per group
  (larger groups raise, and so would a total beyond its result type, which
  that many rows cannot reach). Decimals appear only once per group. On 19.2M
  rows (local[8], one session): 1.52 s, against 4.46 s for per-row decimal
  casts and sums (``PRICING_SUMMARY_SQL``, identical rows) and 1.27 s for
  inexact double sums.
- One aggregation by flag and status. ``HashAggregate(partial)`` runs in the
  scan's whole-stage-codegen stage, so each map task emits at most one row
  per group whatever the skew: a group holding a third (or all) of the rows
  never concentrates raw rows in one task, and the shuffle carries
  ``groups x map tasks`` rows. AQE coalesces the near-empty post-shuffle
  partitions.
- No join, no broadcast, no Python in the plan. The plan is one Spark SQL
  string over the input DataFrame, so building it costs one parse and one
  analysis.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType

from tillandsia.functions.money import (
    DISCOUNT_TYPE,
    PRICE_TYPE,
    cents_sql,
    split_sum_sql,
    split_total_sql,
    unscaled_to_decimal_sql,
)
from tillandsia.sources.tables import read_table

# Default cutoff day and the result types stated on both the
# Spark side and the SQL oracle, so both engines agree on the schema.
DEFAULT_SHIP_CUTOFF = "1998-09-02"
SUM_BASE_PRICE_TYPE = DecimalType(38, 2)
SUM_DISC_PRICE_TYPE = DecimalType(38, 4)
# Bounds of the per-row integers: |price cents| < 10**12 < 2**40, and
# |price cents * (100 - discount cents)| < 10**12 * 10100 < 2**54.
PRICE_CENTS_BITS = 40
NET_UNITS_BITS = 54

# The lineitem columns (and their types in the driver's files) this plan reads.
LINEITEM_COLUMNS = (
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_returnflag STRING, "
    "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
)



def _day_after(day: str) -> str:
    """The day after ``day``, both as ``YYYY-MM-DD``; parsed, so no caller text reaches the SQL."""
    return (dt.date.fromisoformat(day) + dt.timedelta(days=1)).isoformat()


# The same query in ANSI SQL (runs on DuckDB and on Spark SQL); the driver's
# correctness gate compares the plan below against it.
PRICING_SUMMARY_SQL = f"""
SELECT
    l_returnflag,
    l_linestatus,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(12, 2))) AS DECIMAL(38, 2)) AS sum_base_price,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(12, 2))
             * (1 - CAST(l_discount AS DECIMAL(4, 2)))) AS DECIMAL(38, 4)) AS sum_disc_price,
    COUNT(*) AS count_order
FROM lineitem
WHERE l_shipdate < TIMESTAMP '{_day_after(DEFAULT_SHIP_CUTOFF)} 00:00:00'
GROUP BY l_returnflag, l_linestatus
ORDER BY l_returnflag, l_linestatus
""".strip()


def _plan_sql(ship_cutoff: str) -> str:
    day_after = _day_after(ship_cutoff)
    base_total = split_total_sql("base", PRICE_CENTS_BITS, "n")
    net_total = split_total_sql("net", NET_UNITS_BITS, "n")
    base_sums = ", ".join(split_sum_sql("price_cents", PRICE_CENTS_BITS, "base"))
    net_sums = ", ".join(split_sum_sql("net_units", NET_UNITS_BITS, "net"))
    return f"""
WITH in_cents AS (
    SELECT
        l_returnflag,
        l_linestatus,
        {cents_sql("l_extendedprice", PRICE_TYPE)} AS price_cents,
        {cents_sql("l_discount", DISCOUNT_TYPE)} AS discount_cents
    FROM {{lineitem}}
    WHERE l_shipdate < TIMESTAMP_NTZ '{day_after} 00:00:00'
),
netted AS (
    -- price * (1 - discount) in units of 0.0001, exact
    SELECT l_returnflag, l_linestatus, price_cents,
           price_cents * (100 - discount_cents) AS net_units
    FROM in_cents
),
sums AS (
    SELECT l_returnflag, l_linestatus,
           {base_sums},
           {net_sums},
           COUNT(1) AS n
    FROM netted
    GROUP BY l_returnflag, l_linestatus
)
SELECT
    l_returnflag,
    l_linestatus,
    {unscaled_to_decimal_sql(base_total, 2, SUM_BASE_PRICE_TYPE)} AS sum_base_price,
    {unscaled_to_decimal_sql(net_total, 4, SUM_DISC_PRICE_TYPE)} AS sum_disc_price,
    n AS count_order
FROM sums
ORDER BY l_returnflag, l_linestatus
"""


def pricing_summary_of(lineitem: DataFrame, ship_cutoff: str = DEFAULT_SHIP_CUTOFF) -> DataFrame:
    """Pricing summary of any DataFrame with the ``lineitem`` columns used.

    ``ship_cutoff`` is a day (``YYYY-MM-DD``); rows shipped on it, at any
    time, or before are kept. ``l_shipdate`` must be ``timestamp_ntz`` or
    ``date``, so the session time zone plays no part; other types raise
    ``TypeError``. A group of more than 2**49 rows fails the query.
    """
    kind = lineitem.select("l_shipdate").schema[0].dataType
    if not isinstance(kind, TimestampNTZType | DateType):
        raise TypeError(
            f"l_shipdate must be timestamp_ntz or date, not {kind.simpleString()}: "
            "the day of an instant depends on a time zone; convert it first"
        )
    return lineitem.sparkSession.sql(_plan_sql(ship_cutoff), lineitem=lineitem)


def pricing_summary(
    spark: SparkSession, sf_dir: str, ship_cutoff: str = DEFAULT_SHIP_CUTOFF
) -> DataFrame:
    """Pricing summary of the ``lineitem`` table under ``sf_dir``."""
    lineitem = read_table(spark, sf_dir, "lineitem", schema=LINEITEM_COLUMNS)
    return pricing_summary_of(lineitem, ship_cutoff)
