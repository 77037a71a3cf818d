"""Core models (M6-M8): the municipality dimension and the two facts (full builds).

Incremental maintenance of the facts lives in :mod:`keyfig.operators.incremental`; these
functions are the "rebuild from staging" definitions it must agree with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfig.functions.columns import exact_avg, exact_sum, surrogate_key, value_map
from keyfig.operators.joins import distinct_lookup, join_dimension
from keyfig.plans.config import PipelineConfig


def dim_municipalities(seed: DataFrame, cfg: PipelineConfig, with_load_time: bool = True) -> DataFrame:
    """M6: seed rows plus the region's name in the price tables' naming (P8) and the build
    time (P15)."""
    cols = [F.col("municipality_code"), F.col("municipality_name"), F.col("region_code"),
            F.col("region_name"),
            value_map("region_name", cfg.region_local_names).alias("region_name_dst")]
    if with_load_time:
        cols.append(F.current_timestamp().alias("_loaded_at"))
    return seed.select(*cols)


def region_lookup(dim: DataFrame) -> DataFrame:
    """J1 lookup: local region name -> region name, one row each."""
    return distinct_lookup(dim, "region_name_dst", "region_name").select(
        F.col("region_name_dst").alias("_r_dst"), F.col("region_name").alias("_r_name"))


def enrich_housing(src_price_index: DataFrame, dim: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """M7 body without the total filter: category filter (P3) and the J1 left lookup."""
    src = src_price_index.where(F.col("property_category") == F.lit(cfg.category))
    joined = join_dimension(src, region_lookup(dim), F.col("region_name") == F.col("_r_dst"), "left")
    return joined.select(
        "price_index_id",
        F.col("region_name").alias("region_name_dst"),
        F.col("_r_name").alias("region_name"),
        "property_category", "period_quarter", "period_year", "period_quarter_num",
        "price_index", "pct_change_qoq", "pct_change_yoy", "_loaded_at")


def fct_housing_prices(src_price_index: DataFrame, dim: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """M7: housing price fact; the national total row is dropped (P6, NULL-dropping)."""
    return enrich_housing(src_price_index, dim, cfg).where(
        F.col("region_name_dst") != F.lit(cfg.total_area))


def _members(dim: DataFrame) -> DataFrame:
    return dim.select(F.col("municipality_name").alias("_m_name"), F.col("region_name").alias("_m_region"))


def unemployment_by_region(src_unemployment: DataFrame, dim: DataFrame) -> DataFrame:
    """A8 part 1: inner join on municipality name (J2: region and total rows fall out), then
    sum and distinct child count per (region, year)."""
    j = join_dimension(src_unemployment, _members(dim), F.col("area_name") == F.col("_m_name"), "inner")
    return j.groupBy(F.col("_m_region").alias("region_name"), "period_year").agg(
        exact_sum("gross_unemployment_count").alias("total_gross_unemployment"),
        F.count_distinct("area_name").alias("unemployment_areas"),
        F.max("_loaded_at").alias("_lu"))


def income_by_region(src_local_income: DataFrame, dim: DataFrame) -> DataFrame:
    """A8 part 2: unweighted mean of the municipalities' means per (region, year)."""
    j = join_dimension(src_local_income, _members(dim), F.col("municipality_name") == F.col("_m_name"),
                       "inner")
    return j.groupBy(F.col("_m_region").alias("region_name"), "period_year").agg(
        exact_avg("avg_disposable_income_dkk").alias("avg_disposable_income_dkk"),
        F.count_distinct("municipality_name").alias("income_areas"),
        F.max("_loaded_at").alias("_li"))


def combine_labour(u: DataFrame, i: DataFrame) -> DataFrame:
    """J3 + P12: full outer join on (region, year), coalesced keys and coverage count; the
    load time of the newer side is carried so a later watermark can read it (I6)."""
    joined = u.join(i, ["region_name", "period_year"], "full_outer")
    return (joined.where(F.col("region_name").isNotNull())
            .select(surrogate_key("region_name", "period_year").alias("labour_regional_id"),
                    "region_name", "period_year", "total_gross_unemployment",
                    "avg_disposable_income_dkk",
                    F.coalesce("unemployment_areas", "income_areas")
                    .alias("municipality_count"),
                    F.greatest("_lu", "_li").alias("_loaded_at")))


def fct_labour_market_regional(src_unemployment: DataFrame, src_local_income: DataFrame,
                               dim: DataFrame) -> DataFrame:
    """M8: region x year labour fact (full build)."""
    return combine_labour(unemployment_by_region(src_unemployment, dim),
                          income_by_region(src_local_income, dim))
