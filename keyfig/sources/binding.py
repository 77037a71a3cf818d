"""Binding of the shared TPC-H-style test tables to the pipeline's raw (bronze) tables.

The statistics pipeline reads long-format extracts: one row per (dimensions, period) cell,
the value as *text*, with suppression markers, appended load after load.  This module derives
such extracts from ``orders x customer x nation x region`` so every query's work grows with the
test tables:

* regions are TPC-H regions, "municipalities" are customers (so the member-level extracts, the
  dimension and all that is built on them grow with the tables), the price index's provinces are
  nations, categories are market segments, metric members are order priorities, benefit types
  are order statuses;
* every cell value is an exact decimal aggregate of ``o_totalprice`` (or an order count)
  written as text; some cells carry a suppression marker instead;
* two loads are appended: a partial extract (orders before ``CUTOFF``) and a full one.

The price extracts are re-aggregations of one pre-aggregated order cube (:func:`order_cube`), the
member-level ones of a cube per customer and year (:func:`member_cube`); both loads come out of
one aggregation (conditional sums, then ``inline``) and the geographic levels out of one
``groupingSets``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfig.functions.columns import month_string, value_map
from keyfig.operators.joins import BROADCAST_MAX_ROWS, has_at_most, join_dimension
from keyfig.plans.config import (RAW_HOUSING_NATIONAL, RAW_LOCAL_INCOME, RAW_PRICE_INDEX,
                                 RAW_PRICE_REGIONAL, RAW_UNEMPLOYMENT, TPCH_REGION_LOCAL_NAMES,
                                 TPCH_TOTAL)

# Fixed values of the binding (test-data design, mirrored by the DuckDB oracle SQL).
LOAD_1 = "2024-01-01 06:00:00"
LOAD_2 = "2024-01-02 06:00:00"
CUTOFF = "1999-07-01 00:00:00"
CUTOFF_MONTH = "1999M07"   # the cutoff is a month start, so a month is wholly early or not
INCOME_AVG_UNIT = "Average income (DKK)"
INCOME_COUNT_UNIT = "People (number)"
SUPPRESSED = ".."
MISSING = ":"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# The shared test tables are immutable, so the lazy definitions built on them (file listing and
# Parquet footers included) are memoised per session and folder instead of re-listed per query.
_MEMO: dict[tuple, DataFrame] = {}


def _memo(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _memo(spark, sf_dir, f"table:{name}",
                 lambda: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, sf_dir, "geography", lambda: _geography(spark, sf_dir))


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, sf_dir, "order_facts", lambda: _order_facts(spark, sf_dir))


def _geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region: the municipality -> region hierarchy (25 rows by TPC-H definition)."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return join_dimension(n, r, n["n_regionkey"] == r["r_regionkey"], how="inner").select(
        "n_nationkey", "n_name", "r_regionkey", "r_name")


def _order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's segment and nation, as (amount, orders) measures.

    Two plans behind one size check of ``customer``:

    * customer provably small -> broadcast it; orders stream through a map-side join, no
      shuffle of orders at all (and no skew: a broadcast join has no partitions to skew);
    * otherwise -> aggregate orders per (customer, priority, status, month) *before* the join.
      A customer holding a third of all orders collapses map-side to at most priorities x
      statuses x months rows, and the aggregate is already hash-partitioned on the customer
      key the sort-merge join needs, so this adds no shuffle.
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        month_string("o_orderdate").alias("m_str"))
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    if has_at_most(c, BROADCAST_MAX_ROWS):
        oc = o.withColumn("orders", F.lit(1).cast("bigint")).join(
            F.broadcast(c), F.col("o_custkey") == F.col("c_custkey"), "inner")
    else:
        per_customer = o.groupBy("o_custkey", "o_orderpriority", "o_orderstatus", "m_str").agg(
            F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("orders"))
        oc = per_customer.join(c, F.col("o_custkey") == F.col("c_custkey"), "inner")
    return oc.select("o_orderpriority", "o_orderstatus", "c_name", "c_mktsegment", "c_nationkey", "amount",
                     "orders", "m_str")


def member_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per (customer, priority, status, year, load): grows with customers; combined
    map-side, so a customer with a third of all orders is a few rows per task."""
    return _memo(spark, sf_dir, "member_cube", lambda: _member_cube(spark, sf_dir))


def _member_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = order_facts(spark, sf_dir).groupBy(
        "c_name", "c_nationkey", "o_orderpriority", "o_orderstatus", F.left("m_str", F.lit(4)).alias("y_str"),
        (F.col("m_str") < F.lit(CUTOFF_MONTH)).alias("early")).agg(
        F.sum("amount").alias("amount"), F.sum("orders").alias("orders"))
    return join_dimension(cube, geography(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "inner").select(
        "c_name", "r_name", "o_orderpriority", "o_orderstatus", "y_str", "early", "amount", "orders")


def _order_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = order_facts(spark, sf_dir).groupBy(
        "c_mktsegment", "o_orderpriority", "o_orderstatus", "m_str", "c_nationkey").agg(
        F.sum("amount").alias("amount"), F.sum("orders").alias("orders"))
    # the geography is joined to the aggregated cube, not to every order
    cube = join_dimension(cube, geography(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    return cube.select(
        "c_mktsegment", "o_orderpriority", "o_orderstatus", "m_str", "n_name", "r_name", "amount", "orders",
        (F.col("m_str") < F.lit(CUTOFF_MONTH)).alias("early"),
        F.concat(F.left("m_str", F.lit(4)), F.lit("Q"),
                 ((F.substring("m_str", 6, 2).cast("int") + 2) / 3).cast("int").cast("string")).alias("q_str"),
        F.left("m_str", F.lit(4)).alias("y_str"))


def order_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders pre-aggregated to (segment, priority, status, month, nation): the finest grain any
    extract needs.  Its size is bounded by the dimensions, not by the number of orders, and the
    aggregation combines map-side, so a hot key never reaches one task.  Every extract is a
    re-aggregation of this one frame: ``orders`` is scanned and shuffled once per query, and the
    branches reuse that exchange."""
    return _memo(spark, sf_dir, "order_cube", lambda: _order_cube(spark, sf_dir))


def _load_aggs() -> list[Column]:
    return [
        F.sum("amount").alias("s_all"),
        F.sum("orders").alias("n_all"),
        F.sum(F.when(F.col("early"), F.col("amount"))).alias("s_early"),
        F.coalesce(F.sum(F.when(F.col("early"), F.col("orders"))), F.lit(0)).alias("n_early"),
    ]


def _explode_loads(df: DataFrame, keep: list[str | Column]) -> DataFrame:
    """(s_all, n_all, s_early, n_early) -> one row per load with (ts, s, n); empty cells dropped."""
    loads = F.array(
        F.struct(F.lit(LOAD_1).cast("timestamp_ntz").alias("ts"), F.col("s_early").alias("s"),
                 F.col("n_early").alias("n")),
        F.struct(F.lit(LOAD_2).cast("timestamp_ntz").alias("ts"), F.col("s_all").alias("s"),
                 F.col("n_all").alias("n")),
    )
    return df.select(*keep, F.inline(loads)).filter(F.col("n") > 0)


def _money(s: Column, factor: str) -> Column:
    return (s * F.lit(Decimal(factor))).cast("string")


def _suppressed(s: Column) -> Column:
    return (s * 100).cast("bigint") % 7 == 0


def _local_region(c: Column) -> Column:
    return value_map(c, TPCH_REGION_LOCAL_NAMES)


def _finish(df: DataFrame, spec) -> DataFrame:
    return df.select(*[F.col(c) for c in spec.columns],
                     F.col("ts").alias(spec.loaded_at),
                     F.lit(spec.name).alias(spec.src_table))


def raw_price_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = order_cube(spark, sf_dir)
    keys = ["c_mktsegment", "o_orderpriority", "q_str"]
    g = f.groupingSets([[*keys, "r_name", "n_name"], [*keys, "r_name"], keys],
                       *keys, "r_name", "n_name").agg(
        *_load_aggs(), F.grouping("r_name").alias("gr"), F.grouping("n_name").alias("gn"))
    area = (F.when(F.col("gn") == 0, F.col("n_name"))
            .when(F.col("gr") == 0, _local_region(F.col("r_name")))
            .otherwise(F.lit(TPCH_TOTAL)))
    rows = _explode_loads(g, [area.alias("OMRÅDE"), *keys])
    value = (F.when(_suppressed(F.col("s")), F.lit(SUPPRESSED))
             .otherwise(F.regexp_replace(_money(F.col("s"), "0.001"), r"\.", ",")))
    rows = rows.select("OMRÅDE", F.col("c_mktsegment").alias("EJENDOMSKATE"),
                       F.col("o_orderpriority").alias("TAL"), F.col("q_str").alias("TID"),
                       value.alias("INDHOLD"), "ts")
    return _finish(rows, RAW_PRICE_INDEX)


def raw_price_regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = order_cube(spark, sf_dir)
    keys = ["c_mktsegment", "o_orderpriority", "m_str"]
    g = f.groupingSets([[*keys, "r_name"], keys], *keys, "r_name").agg(
        *_load_aggs(), F.grouping("r_name").alias("gr"))
    area = F.when(F.col("gr") == 0, _local_region(F.col("r_name"))).otherwise(F.lit(TPCH_TOTAL))
    rows = _explode_loads(g, [area.alias("REGION"), *keys])
    value = (F.when(_suppressed(F.col("s")), F.lit(SUPPRESSED))
             .when(F.col("o_orderpriority") == "2-HIGH", F.col("n").cast("string"))
             .otherwise(_money(F.col("s"), "0.001")))
    rows = rows.select("REGION", F.col("c_mktsegment").alias("EJENDOMSKATE"),
                       F.col("o_orderpriority").alias("BNØGLE"), F.col("m_str").alias("TID"),
                       value.alias("INDHOLD"), "ts")
    return _finish(rows, RAW_PRICE_REGIONAL)


def raw_unemployment(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = member_cube(spark, sf_dir)
    keys = ["o_orderstatus", "y_str"]
    g = f.groupingSets([[*keys, "r_name", "c_name"], [*keys, "r_name"], keys],
                       *keys, "r_name", "c_name").agg(
        *_load_aggs(), F.grouping("r_name").alias("gr"), F.grouping("c_name").alias("gm"))
    area = (F.when(F.col("gm") == 0, F.col("c_name"))
            .when(F.col("gr") == 0, F.col("r_name"))
            .otherwise(F.lit(TPCH_TOTAL)))
    rows = _explode_loads(g, [area.alias("OMRÅDE"), *keys])
    n = F.col("n").cast("string")
    value = (F.when(F.col("n") % 7 == 0, F.lit(MISSING))
             .when(F.col("n") % 5 == 0, F.concat(F.lit(" "), n, F.lit(" ")))
             .otherwise(n))
    rows = rows.select(F.col("o_orderstatus").alias("YDELSESTYPE"), "OMRÅDE",
                       F.col("y_str").alias("TID"), value.alias("INDHOLD"), "ts")
    return _finish(rows, RAW_UNEMPLOYMENT)


def raw_local_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = member_cube(spark, sf_dir)
    keys = ["o_orderpriority", "y_str"]
    g = f.groupingSets([[*keys, "r_name", "c_name"], [*keys, "r_name"]],
                       *keys, "r_name", "c_name").agg(
        *_load_aggs(), F.grouping("c_name").alias("gm"))
    area = F.when(F.col("gm") == 0, F.col("c_name")).otherwise(F.col("r_name"))
    rows = _explode_loads(g, [area.alias("OMRÅDE"), *keys])
    avg_value = (F.when(_suppressed(F.col("s")), F.lit(SUPPRESSED))
                 .otherwise(_money(F.col("s"), "0.01")))
    units = F.array(
        F.struct(F.lit(INCOME_AVG_UNIT).alias("ENHED"), avg_value.alias("INDHOLD")),
        F.struct(F.lit(INCOME_COUNT_UNIT).alias("ENHED"), F.col("n").cast("string").alias("INDHOLD")),
    )
    rows = rows.select("OMRÅDE", F.col("o_orderpriority").alias("INDKOMSTTYPE"),
                       F.col("y_str").alias("TID"), "ts", F.inline(units))
    return _finish(rows, RAW_LOCAL_INCOME)


def raw_housing_national(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = order_cube(spark, sf_dir)
    keys = ["c_mktsegment", "o_orderpriority", "y_str"]
    g = f.groupBy(*keys).agg(*_load_aggs())
    rows = _explode_loads(g, keys)
    value = (F.when(_suppressed(F.col("s")), F.lit(SUPPRESSED))
             .otherwise(_money(F.col("s"), "0.001")))
    rows = rows.select(F.col("c_mktsegment").alias("EJENDOMSKATE"),
                       F.col("o_orderpriority").alias("BNØGLE"), F.col("y_str").alias("TID"),
                       value.alias("INDHOLD"), "ts")
    return _finish(rows, RAW_HOUSING_NATIONAL)


def _memoised(name, build):
    def get(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _memo(spark, sf_dir, name, lambda: build(spark, sf_dir))
    get.__doc__ = build.__doc__
    return get


RAW_BUILDERS = {
    RAW_PRICE_INDEX.name: _memoised(RAW_PRICE_INDEX.name, raw_price_index),
    RAW_PRICE_REGIONAL.name: _memoised(RAW_PRICE_REGIONAL.name, raw_price_regional),
    RAW_UNEMPLOYMENT.name: _memoised(RAW_UNEMPLOYMENT.name, raw_unemployment),
    RAW_LOCAL_INCOME.name: _memoised(RAW_LOCAL_INCOME.name, raw_local_income),
    RAW_HOUSING_NATIONAL.name: _memoised(RAW_HOUSING_NATIONAL.name, raw_housing_national),
}


def municipality_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The municipality -> region reference table, in the seed's layout (a row per customer)."""
    def build() -> DataFrame:
        c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
        j = join_dimension(c, geography(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        return j.select(F.col("c_custkey").cast("int").alias("municipality_code"),
                        F.col("c_name").alias("municipality_name"),
                        F.col("r_regionkey").cast("int").alias("region_code"),
                        F.col("r_name").alias("region_name"))
    return _memo(spark, sf_dir, "seed", build)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}
