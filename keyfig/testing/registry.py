"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator ID of the
survey's inventory.  Each reads the shared test tables (through the binding) so its work grows
with them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfig.functions.columns import round_half_up
from keyfig.plans.pipeline import Pipeline
from keyfig.session import ensure_settings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(key: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_settings(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        return run
    return deco


_PIPELINES: dict[tuple, Pipeline] = {}


def P(spark: SparkSession, sf_dir: str) -> Pipeline:
    """The pipeline's lazy DataFrame definitions over one folder of (immutable) test tables,
    built once per session like a prepared statement.  No data is cached: every action still
    plans and runs the whole query from the Parquet scans."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _PIPELINES:
        _PIPELINES[key] = Pipeline(spark, sf_dir)
    return _PIPELINES[key]


# ---------------------------------------------------------------- composite queries
@register("M1")
def m1(spark, sf_dir):
    """Staged price index (region x category x quarter)."""
    return P(spark, sf_dir).src_price_index


@register("M2")
def m2(spark, sf_dir):
    return P(spark, sf_dir).src_price_regional


@register("M3")
def m3(spark, sf_dir):
    return P(spark, sf_dir).src_unemployment


@register("M4")
def m4(spark, sf_dir):
    return P(spark, sf_dir).src_local_income


@register("M5")
def m5(spark, sf_dir):
    return P(spark, sf_dir).src_housing_national


@register("M6")
def m6(spark, sf_dir):
    """Municipality dimension (build time left out of the compared output)."""
    return P(spark, sf_dir).dim_municipalities.drop("_loaded_at")


@register("M7")
def m7(spark, sf_dir):
    return P(spark, sf_dir).fct_housing_prices


@register("M8")
def m8(spark, sf_dir):
    """Labour fact; the unweighted mean is shown to 6 decimals (the table keeps full precision)."""
    df = P(spark, sf_dir).fct_labour_market_regional
    return df.withColumn("avg_disposable_income_dkk", round_half_up("avg_disposable_income_dkk", 6))


@register("M9")
def m9(spark, sf_dir):
    return P(spark, sf_dir).mart_housing_affordability


@register("M10")
def m10(spark, sf_dir):
    return P(spark, sf_dir).mart_labour_housing_correlation


# ---------------------------------------------------------------- shared helpers
from functools import reduce  # noqa: E402

from keyfig.functions import columns as C  # noqa: E402
from keyfig.operators import history as H  # noqa: E402
from keyfig.operators import incremental as I  # noqa: E402
from keyfig.operators import joins as J  # noqa: E402
from keyfig.operators import profile as PR  # noqa: E402
from keyfig.operators import quality as Q  # noqa: E402
from keyfig.operators import reshape as R  # noqa: E402
from keyfig.operators import windows as W  # noqa: E402
from keyfig.plans import core as CORE  # noqa: E402
from keyfig.plans import marts as MARTS  # noqa: E402
from keyfig.plans import refresh as REFRESH  # noqa: E402
from keyfig.plans import staging as STG  # noqa: E402
from keyfig.plans.checks import suite  # noqa: E402
from keyfig.plans.run import raw_schema  # noqa: E402
from keyfig.plans.config import (RAW_HOUSING_NATIONAL, RAW_LOCAL_INCOME, RAW_PRICE_INDEX,  # noqa: E402
                                 RAW_PRICE_REGIONAL, RAW_SPECS, RAW_UNEMPLOYMENT, TPCH,
                                 TPCH_REGION_LOCAL_NAMES, PipelineConfig)
from keyfig.session import work_path  # noqa: E402
from keyfig.sources import binding  # noqa: E402
from keyfig.sources import delimited as D  # noqa: E402
from keyfig.sources import ingest as ING  # noqa: E402
from keyfig.sources import sink as SINK  # noqa: E402
from keyfig.operators import changes as CH  # noqa: E402
from keyfig.plans.state import LabourState  # noqa: E402
from keyfig.streaming.filestream import stream_latest_cells  # noqa: E402

RPI, RPR, RUN, RLI, RHN = (s.name for s in (RAW_PRICE_INDEX, RAW_PRICE_REGIONAL, RAW_UNEMPLOYMENT,
                                             RAW_LOCAL_INCOME, RAW_HOUSING_NATIONAL))
TEXT_COLS = {s.name: list(s.columns) for s in RAW_SPECS}


def raw(spark, sf_dir, name):
    return P(spark, sf_dir).raw(name)


def first_load():
    """The first load instant of the binding's raw tables (known, so no pass over them)."""
    return F.lit(binding.LOAD_1).cast("timestamp_ntz")


def labour_rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_disposable_income_dkk", round_half_up("avg_disposable_income_dkk", 6))


def supplier_snapshot(spark, sf_dir, version: int) -> DataFrame:
    """Two extracts of a supplier dimension in the municipality layout: v2 moves the suppliers
    with a balance in [0, 1000] to the next nation, drops those below -500 and adds those at or
    above 9000 (absent from v1)."""
    s = binding.read_table(spark, sf_dir, "supplier")
    n = binding.read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    if version == 1:
        s = s.where(F.col("s_acctbal") < 9000).withColumn("_nk", F.col("s_nationkey").cast("int"))
    else:
        moved = F.col("s_acctbal").between(0, 1000)
        s = (s.where(F.col("s_acctbal") >= -500)
             .withColumn("_nk", F.when(moved, (F.col("s_nationkey") + 1) % 25)
                         .otherwise(F.col("s_nationkey")).cast("int")))
    j = J.join_dimension(s, n, F.col("_nk") == F.col("n_nationkey"), "inner")
    return j.select(F.col("s_suppkey").alias("municipality_code"), F.col("s_name").alias("municipality_name"),
                    F.col("_nk").alias("region_code"), F.col("n_name").alias("region_name"))


SNAP_1, SNAP_2 = "2024-01-01 06:00:00", "2024-02-01 06:00:00"


def scd_history(spark, sf_dir, hard_deletes: bool = True) -> DataFrame:
    check = ["municipality_name", "region_code", "region_name"]
    kept = H.History(spark, work_path(spark, "scd"), "municipality_code", check)
    kept.take(supplier_snapshot(spark, sf_dir, 1), SNAP_1)
    kept.take(supplier_snapshot(spark, sf_dir, 2), SNAP_2, invalidate_hard_deletes=hard_deletes)
    return kept.read()


# ---------------------------------------------------------------- M11-M13
@register("M11")
def m11(spark, sf_dir):
    """Price trend ranking per year (rank, highest price first, unknown prices ahead)."""
    return P(spark, sf_dir).price_trend_ranking


@register("M12")
def m12(spark, sf_dir):
    """Per-region correlation of unemployment with price change (same and next year) and level."""
    return P(spark, sf_dir).unemployment_price_correlation


@register("M13")
def m13(spark, sf_dir):
    """SCD-2 history of a dimension over two snapshots, hard deletes closed."""
    return scd_history(spark, sf_dir, hard_deletes=True)


@register("H1")
def h1(spark, sf_dir):
    """SCD-2 check strategy only (deleted keys stay open)."""
    return scd_history(spark, sf_dir, hard_deletes=False)


@register("H2")
def h2(spark, sf_dir):
    """Versions closed because their key disappeared."""
    hist = scd_history(spark, sf_dir, hard_deletes=True)
    v2 = supplier_snapshot(spark, sf_dir, 2).select("municipality_code")
    return J.anti_join(hist.where(F.col("valid_to").isNotNull()), v2, "municipality_code")


# ---------------------------------------------------------------- sources and sinks
@register("S1")
def s1(spark, sf_dir):
    """Land an extract as ';'-separated text with decimal commas, one load with its columns in
    another order, scan both folders back in one read, parse numbers."""
    path = work_path(spark, "s1")
    r = raw(spark, sf_dir, RPI)
    D.write_delimited(r.where(F.col("_LOADED_AT") <= first_load()).select(*TEXT_COLS[RPI]), f"{path}/a")
    D.write_delimited(r.where(F.col("_LOADED_AT") > first_load()).select(*reversed(TEXT_COLS[RPI])), f"{path}/b")
    df = D.read_delimited(spark, [f"{path}/a", f"{path}/b"], TEXT_COLS[RPI])
    return df.withColumn("value", C.parse_number("INDHOLD", decimal_comma=True))


@register("S2")
def s2(spark, sf_dir):
    """Messy headers (byte-order mark, blanks, lower case) normalised on read."""
    path = work_path(spark, "s2")
    src = raw(spark, sf_dir, RHN).select(
        F.col("EJENDOMSKATE").alias("\ufeffEjendomskate"), F.col("BNØGLE").alias("bnøgle "),
        F.col("TID").alias(" tid"), F.col("INDHOLD").alias("Indhold"),
        F.col("_LOADED_AT").cast("string").alias("_loaded at"))
    src.write.option("sep", ";").option("header", True).csv(path)
    return D.read_delimited(spark, path)


@register("S3")
def s3(spark, sf_dir):
    """Chunked landing by period (3 periods per chunk), all chunks read back in one scan."""
    path = work_path(spark, "s3")
    paths = D.land_chunked(raw(spark, sf_dir, RLI).select(*TEXT_COLS[RLI]), path, "TID", 3)
    return D.read_chunks(spark, paths, TEXT_COLS[RLI])


@register("S4")
def s4(spark, sf_dir):
    """Suppression markers -> NULL in every text column."""
    return R.clean_sentinels(raw(spark, sf_dir, RUN))


@register("S5")
def s5(spark, sf_dir):
    """Audit columns: one load instant per table and the source id."""
    return D.with_audit(raw(spark, sf_dir, RHN).select(*TEXT_COLS[RHN]), "LABY22", "2024-03-01 06:00:00")


@register("S6")
def s6(spark, sf_dir):
    """Every column as text, NULL kept NULL."""
    return R.stringify(P(spark, sf_dir).src_unemployment)


@register("S7")
def s7(spark, sf_dir):
    """Sink: overwrite then append the same rows; read back the table (bag of both writes)."""
    path = work_path(spark, "s7")
    df = P(spark, sf_dir).src_unemployment
    n1 = SINK.write_table(df, path, overwrite=True)
    n2 = SINK.write_table(df, path)
    assert n1 == n2
    return spark.read.parquet(path)


@register("S8")
def s8(spark, sf_dir):
    """Table-exists probe after landing two raw tables (and one never landed)."""
    base = work_path(spark, "s8")
    rows = []
    for name in (RUN, RHN):
        n = SINK.write_table(raw(spark, sf_dir, name), f"{base}/{name}")
        rows.append((name, SINK.table_exists(spark, f"{base}/{name}"), n))
    rows.append(("RAW_MISSING", SINK.table_exists(spark, f"{base}/RAW_MISSING"), 0))
    return spark.createDataFrame(rows, "table_name string, table_exists boolean, n_rows bigint")


@register("S9")
def s9(spark, sf_dir):
    """Config-driven ingest of five landed extracts plus one missing source (skipped)."""
    base = work_path(spark, "s9")
    ids = {RPI: "EJ56", RPR: "EJ131", RUN: "AUL01", RLI: "INDKP101", RHN: "LABY22"}
    specs = []
    for name, sid in ids.items():
        D.write_delimited(raw(spark, sf_dir, name).select(*TEXT_COLS[name]), f"{base}/landing/{name}")
        specs.append(ING.SourceSpec(sid, name, (f"{base}/landing/{name}",), tuple(TEXT_COLS[name])))
    specs.append(ING.SourceSpec("MISSING", "RAW_MISSING", (f"{base}/landing/none",), ("A",)))
    status = ING.ingest_all(spark, specs, f"{base}/warehouse", loaded_at="2024-03-01 06:00:00")
    return status.select("source_id", "target", "status", "rows")


@register("S10")
def s10(spark, sf_dir):
    """Warehouse table scan of a landed raw table."""
    path = work_path(spark, "s10")
    SINK.write_table(raw(spark, sf_dir, RUN), path)
    return spark.read.parquet(path)


@register("S11")
def s11(spark, sf_dir):
    """Seed CSV with an explicit schema."""
    path = work_path(spark, "s11")
    binding.municipality_seed(spark, sf_dir).write.option("header", True).csv(path)
    return ING.read_seed(spark, path)


@register("S12")
def s12(spark, sf_dir):
    """A model reading other models: the housing fact over materialised staging + dimension."""
    p = P(spark, sf_dir)
    staged = SINK.materialise(p.src_price_index, "table", path=work_path(spark, "s12"))
    dim = SINK.materialise(p.dim_municipalities, "view", name="dim_municipalities")
    return CORE.fct_housing_prices(staged, dim, TPCH)


@register("S13")
def s13(spark, sf_dir):
    """Materialised as a view, as a table (written once, read back), and incrementally: an older
    version of half of the rows without one column, then the rows as they are."""
    dim = P(spark, sf_dir).dim_municipalities.drop("_loaded_at")
    path = work_path(spark, "s13")
    SINK.materialise(dim.where(F.pmod("municipality_code", F.lit(2)) == 0).withColumn("municipality_name", F.upper("municipality_name")).drop("region_name_dst"),
                     "incremental", path=f"{path}/rows", keys=["municipality_code"])
    modes = {"view": SINK.materialise(dim, "view", name="s13_view"), "table": SINK.materialise(dim, "table", path=f"{path}/table"),
             "incremental": SINK.materialise(dim, "incremental", path=f"{path}/rows", keys=["municipality_code"])}
    return reduce(DataFrame.unionByName, [df.withColumn("mode", F.lit(mode)) for mode, df in modes.items()])


@register("S14")
def s14(spark, sf_dir):
    """CSV export with normalised header; rows written reported by the write itself."""
    path = work_path(spark, "s14")
    n = D.write_delimited(raw(spark, sf_dir, RHN).select(*TEXT_COLS[RHN]), path)
    return D.read_delimited(spark, path, TEXT_COLS[RHN]).withColumn("rows_written", F.lit(n).cast("bigint"))


@register("S15")
def s15(spark, sf_dir):
    """Nested metadata document written as JSON, read back, one variable's members."""
    path = work_path(spark, "s15")
    dims = ["OMRÅDE", "EJENDOMSKATE", "TAL", "TID"]
    PR.metadata_document(raw(spark, sf_dir, RPI), dims, "TID").write.json(path)
    return PR.variable_members(PR.read_metadata(spark, path), "tal")


# ---------------------------------------------------------------- projections and filters
@register("P1")
def p1(spark, sf_dir):
    """Rename, including non-ASCII source identifiers."""
    return raw(spark, sf_dir, RPI).select(
        F.col("OMRÅDE").alias("area"), F.col("EJENDOMSKATE").alias("category"), F.col("TAL").alias("metric"),
        F.col("TID").alias("period"), F.col("INDHOLD").alias("value_text"), F.col("_LOADED_AT").alias("loaded_at"))


@register("P2")
def p2(spark, sf_dir):
    """Two-column projection (unused columns never reach the plan)."""
    return raw(spark, sf_dir, RUN).select("TID", "INDHOLD")


@register("P3")
def p3(spark, sf_dir):
    return raw(spark, sf_dir, RPR).where(F.col("EJENDOMSKATE") == TPCH.category)


@register("P4")
def p4(spark, sf_dir):
    return raw(spark, sf_dir, RLI).where((F.col("ENHED") == TPCH.income_unit)
                                         & (F.col("INDKOMSTTYPE") == TPCH.income_type))


@register("P5")
def p5(spark, sf_dir):
    return raw(spark, sf_dir, RPI).where(F.col("OMRÅDE").isin(list(TPCH.price_index_areas)))


@register("P6")
def p6(spark, sf_dir):
    """NULL-dropping inequality filter removing the total rows."""
    p = P(spark, sf_dir)
    return CORE.enrich_housing(p.src_price_index, p.dim_municipalities, TPCH).where(
        F.col("region_name_dst") != TPCH.total_area)


@register("P7")
def p7(spark, sf_dir):
    return P(spark, sf_dir).fct_housing_prices.where(F.col("price_index").isNotNull())


@register("P8")
def p8(spark, sf_dir):
    return P(spark, sf_dir).dim_municipalities.select("region_name", "region_name_dst").distinct()


@register("P9")
def p9(spark, sf_dir):
    return P(spark, sf_dir).mart_labour_housing_correlation.select(
        "region_name", "period_year", "price_to_income_ratio", "affordability_tier")


@register("P10")
def p10(spark, sf_dir):
    return P(spark, sf_dir).mart_labour_housing_correlation.select(
        "region_name", "period_year", "total_gross_unemployment", "avg_annual_price_mdkk",
        "avg_disposable_income_dkk", "price_to_income_ratio", "has_full_data")


@register("P11")
def p11(spark, sf_dir):
    return P(spark, sf_dir).mart_labour_housing_correlation.select(
        "region_name", "period_year", "quarters_with_data", "is_full_year")


def _labour_parts(spark, sf_dir):
    p = P(spark, sf_dir)
    return (CORE.unemployment_by_region(p.src_unemployment, p.dim_municipalities),
            CORE.income_by_region(p.src_local_income, p.dim_municipalities))


@register("P12")
def p12(spark, sf_dir):
    u, i = _labour_parts(spark, sf_dir)
    return CORE.combine_labour(u, i).select("region_name", "period_year", "municipality_count")


@register("P13")
def p13(spark, sf_dir):
    return MARTS.annual_regional_prices(P(spark, sf_dir).src_price_regional).select(
        F.col("_rp_region").alias("region_name"), F.col("_rp_year").alias("period_year"), "avg_annual_price_mdkk")


@register("P14")
def p14(spark, sf_dir):
    return P(spark, sf_dir).mart_housing_affordability.select(
        "region_name", "period_year", "avg_annual_price_mdkk", "avg_disposable_income_dkk", "price_to_income_ratio")


@register("P15")
def p15(spark, sf_dir):
    dim = P(spark, sf_dir).dim_municipalities
    # the build instant: one for all rows, and within the hour before now
    one = dim.agg(F.count_distinct("_loaded_at").alias("instants"))
    recent = F.col("_loaded_at").between(F.current_timestamp() - F.expr("INTERVAL 1 HOUR"), F.current_timestamp())
    return dim.crossJoin(F.broadcast(one)).select("municipality_code", (recent & (F.col("instants") == 1)).alias("has_load_time"))


# ---------------------------------------------------------------- joins
@register("J1")
def j1(spark, sf_dir):
    """Left join to a DISTINCT-ed lookup (no fan-out)."""
    p = P(spark, sf_dir)
    return CORE.enrich_housing(p.src_price_index, p.dim_municipalities, TPCH)


@register("J2")
def j2(spark, sf_dir):
    """Inner join on names that doubles as a filter (region and total rows fall out)."""
    p = P(spark, sf_dir)
    m = p.dim_municipalities.select(F.col("municipality_name").alias("_m"), "region_name")
    return J.join_dimension(p.src_unemployment, m, F.col("area_name") == F.col("_m"), "inner").select(
        "area_name", "region_name", "period_year", "gross_unemployment_count")


@register("J3")
def j3(spark, sf_dir):
    """Full outer join on two keys with coalesced keys."""
    u, i = _labour_parts(spark, sf_dir)
    return labour_rounded(CORE.combine_labour(u, i)).select(
        "region_name", "period_year", "total_gross_unemployment", "avg_disposable_income_dkk",
        "municipality_count")


@register("J4")
def j4(spark, sf_dir):
    p = P(spark, sf_dir)
    h = MARTS.annual_housing(p.fct_housing_prices)
    lab = p.fct_labour_market_regional.select(F.col("region_name").alias("_r"), F.col("period_year").alias("_y"),
                                              "total_gross_unemployment", "municipality_count")
    return h.join(lab, (F.col("region_name") == F.col("_r")) & (F.col("period_year") == F.col("_y")), "left").select(
        "region_name", "period_year", "avg_annual_price_index", "total_gross_unemployment", "municipality_count")


@register("J5")
def j5(spark, sf_dir):
    """Left join on differently named keys (the second naming of regions)."""
    p = P(spark, sf_dir)
    h = MARTS.annual_housing(p.fct_housing_prices)
    rp = MARTS.annual_regional_prices(p.src_price_regional)
    cond = (F.col("region_name_dst") == F.col("_rp_region")) & (F.col("period_year") == F.col("_rp_year"))
    return h.join(rp, cond, "left").select("region_name_dst", "period_year", "avg_annual_price_index",
                                           "avg_annual_price_mdkk", "annual_sales_count")


def _staged_first_load_unemployment(spark, sf_dir):
    r = raw(spark, sf_dir, RUN)
    return STG.src_unemployment(r.where(F.col("_LOADED_AT") <= first_load()), TPCH)


@register("J6")
def j6(spark, sf_dir):
    """Rows newer than the target's maximum, as a scalar subquery in one plan."""
    target = _staged_first_load_unemployment(spark, sf_dir)
    return I.after_watermark_subquery(raw(spark, sf_dir, RUN), target)


@register("J7")
def j7(spark, sf_dir):
    """Anti join: area names with no dimension member (what the inner join J2 drops)."""
    p = P(spark, sf_dir)
    names = p.dim_municipalities.select(F.col("municipality_name").alias("area_name"))
    return J.anti_join(p.src_unemployment.select("area_name").distinct(), names, "area_name")


@register("J8")
def j8(spark, sf_dir):
    """Semi join with the latest 8 periods."""
    return W.keep_last_n_periods(raw(spark, sf_dir, RPI), "TID", 8)


# ---------------------------------------------------------------- aggregations
@register("A1")
def a1(spark, sf_dir):
    """EAV pivot of every category (latest load per cell)."""
    r = raw(spark, sf_dir, RHN)
    df = r.select(F.col("EJENDOMSKATE").alias("property_category"), F.col("BNØGLE").alias("metric"),
                  F.col("TID").alias("tid"), C.parse_number("INDHOLD").alias("value"),
                  F.col("_LOADED_AT").alias("loaded_at"))
    return R.pivot_metrics(df, ["property_category", "tid"], "metric", "value",
                           TPCH.housing_national_metrics, loaded_at="loaded_at")


@register("A2")
def a2(spark, sf_dir):
    """Pivot with the original 'largest value across loads' rule, carrying max(_loaded_at)."""
    cfg = PipelineConfig(**{**TPCH.__dict__, "resolve": "max"})
    return STG.src_price_regional(raw(spark, sf_dir, RPR), cfg).select(
        "region_name", "property_category", "period_month", *TPCH.price_regional_metrics.values(), "_loaded_at")


@register("A3")
def a3(spark, sf_dir):
    u, _ = _labour_parts(spark, sf_dir)
    return u.select("region_name", "period_year", "total_gross_unemployment")


@register("A4")
def a4(spark, sf_dir):
    _, i = _labour_parts(spark, sf_dir)
    return i.select("region_name", "period_year",
                    round_half_up("avg_disposable_income_dkk", 6).alias("avg_disposable_income_dkk"),
                    round_half_up("avg_disposable_income_dkk", 0).alias("avg_disposable_income_rounded"))


@register("A5")
def a5(spark, sf_dir):
    return MARTS.annual_housing(P(spark, sf_dir).fct_housing_prices).select(
        "region_name", "region_name_dst", "period_year", "quarters_with_data")


@register("A6")
def a6(spark, sf_dir):
    u, i = _labour_parts(spark, sf_dir)
    return u.join(i, ["region_name", "period_year"], "full_outer").select(
        "region_name", "period_year", F.col("unemployment_areas").alias("municipality_count_unemp"),
        F.col("income_areas").alias("municipality_count_income"))


@register("A7")
def a7(spark, sf_dir):
    """Global maximum load time (watermark) of every raw table."""
    parts = [raw(spark, sf_dir, s.name).agg(F.max("_LOADED_AT").alias("max_loaded_at"))
             .select(F.lit(s.name).alias("table_name"), "max_loaded_at") for s in RAW_SPECS]
    return reduce(DataFrame.unionByName, parts)


@register("A8")
def a8(spark, sf_dir):
    """Hierarchical roll-up municipality -> region (sum, unweighted mean, coverage)."""
    return labour_rounded(P(spark, sf_dir).fct_labour_market_regional).select(
        "region_name", "period_year", "total_gross_unemployment", "avg_disposable_income_dkk",
        "municipality_count")


@register("A9")
def a9(spark, sf_dir):
    """Calendar roll-up month -> year."""
    return MARTS.annual_regional_prices(P(spark, sf_dir).src_price_regional).select(
        F.col("_rp_region").alias("region_name"), F.col("_rp_year").alias("period_year"),
        "avg_annual_price_mdkk", "annual_sales_count")


def _pi_profile(spark, sf_dir):
    return PR.dimension_profile(raw(spark, sf_dir, RPI), ["OMRÅDE", "EJENDOMSKATE", "TAL", "TID"], "TID",
                                eliminable=("EJENDOMSKATE",))


@register("A10")
def a10(spark, sf_dir):
    """Dimension profile: members per variable, first five, time / eliminable flags."""
    return _pi_profile(spark, sf_dir)


@register("A11")
def a11(spark, sf_dir):
    """Cell-count estimate of a full extract and the warning flags."""
    return PR.estimate_cells(_pi_profile(spark, sf_dir))


@register("A12")
def a12(spark, sf_dir):
    """Dimension elimination: totals over the category dimension."""
    df = raw(spark, sf_dir, RPI).withColumn("value", C.parse_number("INDHOLD", decimal_comma=True))
    out = R.eliminate_dimension(df, ["EJENDOMSKATE"], "value", keep=["OMRÅDE", "TAL", "TID", "_LOADED_AT"])
    return out.withColumn("value", round_half_up("value", 6))


@register("A13")
def a13(spark, sf_dir):
    """GROUP BY ordinal positions in SQL."""
    view = "raw_unemployment_a13"
    raw(spark, sf_dir, RUN).createOrReplaceTempView(view)
    return spark.sql(f"SELECT `OMRÅDE`, `TID`, count(*) AS n_cells FROM {view} GROUP BY 1, 2")


# ---------------------------------------------------------------- windows, sorts, sets
@register("W1")
def w1(spark, sf_dir):
    return P(spark, sf_dir).price_trend_ranking


@register("W2")
def w2(spark, sf_dir):
    """Year-over-year absolute change, joined on year - 1 (gap-safe)."""
    h = MARTS.annual_housing(P(spark, sf_dir).fct_housing_prices)
    return W.change_vs_previous(h, ["region_name"], "period_year", "avg_annual_price_index",
                                name="yoy_change", digits=1).select(
        "region_name", "region_name_dst", "period_year", "avg_annual_price_index", "yoy_change")


@register("W3")
def w3(spark, sf_dir):
    """Quarter-over-quarter %-change recomputed from the index."""
    f = P(spark, sf_dir).fct_housing_prices.withColumn(
        "_q", F.col("period_year") * 4 + F.col("period_quarter_num"))
    return W.change_vs_previous(f, ["region_name_dst"], "_q", "price_index", name="qoq_recomputed",
                                pct=True, digits=1).select(
        "price_index_id", "region_name_dst", "period_quarter", "price_index", "qoq_recomputed")


@register("O1")
def o1(spark, sf_dir):
    """Sorted; the place that each row has in the sorted result is part of it."""
    return W.with_position(P(spark, sf_dir).price_trend_ranking, ["period_year", "price_rank", "region_name"])


@register("O2")
def o2(spark, sf_dir):
    return W.with_position(raw(spark, sf_dir, RUN), ["TID", "_LOADED_AT", "YDELSESTYPE", "OMRÅDE"])


@register("O3")
def o3(spark, sf_dir):
    return W.last_n_periods(raw(spark, sf_dir, RPI), "TID", 8)


@register("O4")
def o4(spark, sf_dir):
    long = PR.stack_members(raw(spark, sf_dir, RUN), ["YDELSESTYPE", "OMRÅDE", "TID"])
    return W.first_k_members(long, "variable", "member", 5)


@register("U1")
def u1(spark, sf_dir):
    """Bag union of the per-load slices of an extract."""
    r = raw(spark, sf_dir, RLI).select(*TEXT_COLS[RLI], "_LOADED_AT")
    parts = [r.where(F.col("_LOADED_AT") <= first_load()), r.where(F.col("_LOADED_AT") > first_load())]
    return reduce(DataFrame.unionByName, parts).select(*TEXT_COLS[RLI])


@register("U2")
def u2(spark, sf_dir):
    return CORE.region_lookup(P(spark, sf_dir).dim_municipalities).select(
        F.col("_r_dst").alias("region_name_dst"), F.col("_r_name").alias("region_name"))


@register("U3")
def u3(spark, sf_dir):
    """Append of each new load to the raw history, as a whole and once: the second load dies before
    its manifest entry, is loaded, and loaded again."""
    path = work_path(spark, "u3")
    r = raw(spark, sf_dir, RUN)
    first, second = r.where(F.col("_LOADED_AT") <= first_load()), r.where(F.col("_LOADED_AT") > first_load())
    CH.append_load(first, path, "load 1", "TID", ["_LOADED_AT"])
    CH.Store(spark, path).stage(second, "rows", "TID")
    n = [CH.append_load(second, path, "load 2", "TID", ["_LOADED_AT"]) for _ in range(2)]
    assert n[0] == n[1]
    return CH.read_loads(spark, path, r.schema, "TID")


# ---------------------------------------------------------------- scalar functions
def _periods(spark, sf_dir, name):
    return raw(spark, sf_dir, name).select(F.col("TID").alias("tid")).distinct()


def _all_periods(spark, sf_dir):
    return (_periods(spark, sf_dir, RPI).union(_periods(spark, sf_dir, RPR))
            .union(_periods(spark, sf_dir, RUN)).distinct())


@register("F1")
def f1(spark, sf_dir):
    t = F.col("tid")
    return _periods(spark, sf_dir, RPR).select("tid", F.left(t, F.lit(4)).alias("year_part"),
                                               F.right(t, F.lit(2)).alias("month_part"))


@register("F2")
def f2(spark, sf_dir):
    return _periods(spark, sf_dir, RPR).select("tid", F.substring("tid", 6, 2).alias("month_part"))


@register("F3")
def f3(spark, sf_dir):
    t = F.col("tid")
    month = ((C.period_sub(t, 1) - 1) * 3 + 1).cast("string")
    return _periods(spark, sf_dir, RPI).select(
        "tid", F.concat(F.left(t, F.lit(4)), F.lit("-"), F.lpad(month, 2, "0"), F.lit("-01")).alias("first_day_text"))


@register("F4")
def f4(spark, sf_dir):
    t = F.col("tid")
    return _all_periods(spark, sf_dir).select(
        "tid", t.rlike(r"^[0-9]{4}\z").alias("is_year"), t.rlike(r"^[0-9]{4}[KQ][1-4]\z").alias("is_quarter"),
        t.rlike(r"^[0-9]{4}M[0-9]{2}\z").alias("is_month"))


@register("F5")
def f5(spark, sf_dir):
    return _all_periods(spark, sf_dir).select("tid", C.period_to_date("tid").alias("period_date"))


@register("F6")
def f6(spark, sf_dir):
    t = F.col("tid")
    nxt = F.lpad((F.substring(t, 6, 2).cast("int") + 1).cast("string"), 2, "0")
    return _periods(spark, sf_dir, RPR).select(
        "tid",
        F.try_to_date(F.concat(F.left(t, F.lit(4)), F.lit("-"), F.substring(t, 6, 2), F.lit("-01")),
                      "yyyy-MM-dd").alias("month_start"),
        F.try_to_date(F.concat(F.left(t, F.lit(4)), F.lit("-"), nxt, F.lit("-01")),
                      "yyyy-MM-dd").alias("next_month_start"))


@register("F7")
def f7(spark, sf_dir):
    return _periods(spark, sf_dir, RUN).select("tid", C.strict_int("tid").alias("period_year"))


@register("F8")
def f8(spark, sf_dir):
    return raw(spark, sf_dir, RUN).select(F.col("INDHOLD").alias("value_text"),
                                          C.parse_number("INDHOLD").alias("value")).distinct()


@register("F9")
def f9(spark, sf_dir):
    return P(spark, sf_dir).src_unemployment.select(
        "area_name", F.col("period_year").cast("string").alias("period_text")).distinct()


@register("F10")
def f10(spark, sf_dir):
    return P(spark, sf_dir).src_price_index.select(
        "price_index_id", *[round_half_up("price_index", n).alias(f"r{n}") for n in (0, 1, 2)])


@register("F11")
def f11(spark, sf_dir):
    return P(spark, sf_dir).fct_labour_market_regional.select("region_name", "period_year", "municipality_count")


@register("F12")
def f12(spark, sf_dir):
    return p15(spark, sf_dir)


@register("F13")
def f13(spark, sf_dir):
    r = raw(spark, sf_dir, RUN).where(F.col("YDELSESTYPE") == TPCH.unemployment_type)
    return r.select(F.col("OMRÅDE").alias("area_name"), F.col("TID").alias("tid")).distinct().withColumn(
        "unemployment_id", C.surrogate_key("area_name", "tid"))


@register("F14")
def f14(spark, sf_dir):
    v = F.col("avg_price_dkk_1000")
    return P(spark, sf_dir).src_price_regional.select(
        "price_regional_id", (v * 1000).alias("avg_price_dkk"), (v / 1000).alias("avg_price_mdkk"),
        (v > 1000).alias("above_million"))


@register("F15")
def f15(spark, sf_dir):
    return s2(spark, sf_dir)


@register("F16")
def f16(spark, sf_dir):
    j = F.to_json(F.struct(F.col("member").alias("id"), F.col("member").alias("text")))
    return raw(spark, sf_dir, RPI).select(F.col("TAL").alias("member")).distinct().select(
        "member", j.alias("member_json"), F.get_json_object(j, "$.id").alias("member_id"))


# ---------------------------------------------------------------- incremental and streaming
def landed_raw(spark, sf_dir, spec) -> DataFrame:
    """A raw history as the daily run keeps it: stored, partitioned by period, periods as text."""
    path = work_path(spark, "raw", spec.name)
    SINK.write_table(raw(spark, sf_dir, spec.name), path, partition_by=[spec.period])
    return spark.read.schema(raw_schema(spec)).parquet(path)


@register("I1")
def i1(spark, sf_dir):
    """Watermark filter: rows newer than the published target's high-water mark."""
    target = I.publish(_staged_first_load_unemployment(spark, sf_dir), work_path(spark, "i1"))
    return I.after_watermark(raw(spark, sf_dir, RUN), I.watermark(target))


def _housing_from(raw_pi: DataFrame, spark, sf_dir) -> DataFrame:
    return CORE.fct_housing_prices(STG.src_price_index(raw_pi, TPCH), P(spark, sf_dir).dim_municipalities, TPCH)


@register("I2")
def i2(spark, sf_dir):
    """Keyed upsert: the cells touched after the watermark, rebuilt and written as a change of the
    first load's fact, merged by key when read."""
    r = landed_raw(spark, sf_dir, RAW_PRICE_INDEX)
    dim = P(spark, sf_dir).dim_municipalities
    before, new = r.where(F.col("_LOADED_AT") <= first_load()), r.where(F.col("_LOADED_AT") > first_load())
    store = CH.Store(spark, work_path(spark, "i2"))
    first = _housing_from(before, spark, sf_dir)
    store.commit([store.stage(first, "rows", REFRESH.PARTITION, REFRESH.HOUSING_KEYS)])
    fresh, keys = REFRESH.housing_change(r, new, dim, TPCH)
    store.commit([store.stage(fresh, "rows", REFRESH.PARTITION, REFRESH.HOUSING_KEYS, gone=keys)])
    return store.read("rows", first.schema, REFRESH.PARTITION, REFRESH.HOUSING_KEYS)


@register("I3")
def i3(spark, sf_dir):
    """Upsert into a target of an older schema (one column missing, one obsolete)."""
    base = work_path(spark, "i3")
    r = raw(spark, sf_dir, RPI)
    old = (_housing_from(r.where(F.col("_LOADED_AT") <= first_load()), spark, sf_dir)
           .drop("pct_change_qoq").withColumn("legacy_flag", F.lit(True)))
    # cells of an area that the second load does not have: they stay, in the new schema
    gone = old.where(F.col("region_name_dst") == TPCH.price_index_areas[1]).withColumns({
        "price_index_id": F.concat(F.lit("closed-"), "price_index_id"), "region_name_dst": F.lit("Region Closed")})
    target = I.publish(old.unionByName(gone), base)
    batch = I.publish(_housing_from(I.after_watermark(r, I.watermark(target)), spark, sf_dir), work_path(spark, "i3_batch"))
    return I.publish(I.upsert(I.read_current(spark, base), batch, "price_index_id"), base)


@register("I4")
def i4(spark, sf_dir):
    """Full refresh: overwrite twice, the table holds one build."""
    path = work_path(spark, "i4")
    f = P(spark, sf_dir).fct_housing_prices
    SINK.write_table(f, path, overwrite=True)
    SINK.write_table(f, path, overwrite=True)
    return spark.read.parquet(path)


@register("I5")
def i5(spark, sf_dir):
    """Latest-load dedupe of appended full extracts."""
    return R.latest_by(raw(spark, sf_dir, RUN), ["YDELSESTYPE", "OMRÅDE", "TID"], ["_LOADED_AT", "INDHOLD"])


@register("I6")
def i6(spark, sf_dir):
    """The labour fact as a state to which loads are applied as signed deltas; equals a full rebuild."""
    ru, ri = raw(spark, sf_dir, RUN), raw(spark, sf_dir, RLI)
    state = LabourState(spark, work_path(spark, "i6"), P(spark, sf_dir).dim_municipalities, TPCH)
    early = [r.where(F.col("_LOADED_AT") <= first_load()) for r in (ru, ri)]
    late = [r.where(F.col("_LOADED_AT") > first_load()) for r in (ru, ri)]
    # three loads: the first without one year of income, the late income load, the second load
    lost = F.col("TID") == "1997"
    for load in ((early[0], early[1].where(~lost)), (early[0].limit(0), early[1].where(lost)), late):
        state.commit(state.apply(*load))
    return labour_rounded(state.fact())


@register("T1")
def t1(spark, sf_dir):
    """Landed load files as a stream: newest cell wins, then staged as usual."""
    base = work_path(spark, "t1")
    r = raw(spark, sf_dir, RUN)

    def run() -> DataFrame:
        return stream_latest_cells(spark, f"{base}/landing/*", r.schema, ["YDELSESTYPE", "OMRÅDE", "TID"],
                                   ["_LOADED_AT", "INDHOLD"], f"{base}/cells", f"{base}/checkpoint", partition_col="TID")
    # the loads land one after the other, the newer one first; the stream runs after each
    r.where(F.col("_LOADED_AT") > first_load()).write.parquet(f"{base}/landing/load=2")
    run()
    r.where(F.col("_LOADED_AT") <= first_load()).write.parquet(f"{base}/landing/load=1")
    return STG.src_unemployment(run(), TPCH)


# ---------------------------------------------------------------- quality
@register("Q1")
def q1(spark, sf_dir):
    """unique on the staged key without latest-load dedupe: every re-delivered cell fails."""
    cfg = PipelineConfig(**{**TPCH.__dict__, "resolve": "max"})
    return Q.unique(STG.src_unemployment(raw(spark, sf_dir, RUN), cfg), "unemployment_id")


@register("Q2")
def q2(spark, sf_dir):
    return Q.null_counts(P(spark, sf_dir).mart_housing_affordability)


@register("Q3")
def q3(spark, sf_dir):
    return Q.accepted_values(raw(spark, sf_dir, RPI), "OMRÅDE", list(TPCH.price_index_areas))


@register("Q4")
def q4(spark, sf_dir):
    p = P(spark, sf_dir)
    checks = [Q.Check("between", "src_unemployment", "gross_unemployment_count", min_value=0),
              Q.Check("between", "src_local_income", "avg_disposable_income_dkk", min_value=0,
                      max_value=2_000_000)]
    res = Q.run_checks(spark, {"src_unemployment": p.src_unemployment,
                               "src_local_income": p.src_local_income}, checks)
    return res.drop("status")


@register("Q5")
def q5(spark, sf_dir):
    sources = {s.name: raw(spark, sf_dir, s.name) for s in RAW_SPECS}
    return Q.freshness(sources, TPCH.freshness, "2024-04-15 06:00:00")


@register("Q6")
def q6(spark, sf_dir):
    """The whole declarative suite over every built model, one result row per check."""
    p = P(spark, sf_dir)
    models = {"seed": p.seed, "src_price_index": p.src_price_index,
              "src_price_regional": p.src_price_regional, "src_unemployment": p.src_unemployment,
              "src_local_income": p.src_local_income, "src_housing_national": p.src_housing_national,
              "dim_municipalities": p.dim_municipalities, "fct_housing_prices": p.fct_housing_prices,
              "fct_labour_market_regional": p.fct_labour_market_regional,
              "mart_housing_affordability": p.mart_housing_affordability,
              "mart_labour_housing_correlation": p.mart_labour_housing_correlation}
    return Q.run_checks(spark, models, suite(TPCH, tuple(TPCH_REGION_LOCAL_NAMES)))
