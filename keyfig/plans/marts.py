"""Marts and analyses.

Every source is rolled up to (region, year) *before* it is joined, so the joins only ever see
aggregates: at any scale the mart's joins are between small frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyfig.functions.columns import (all_not_null, band, equals_flag, exact_avg, exact_sum,
                                      round_half_up, safe_ratio)
from keyfig.plans.config import PipelineConfig

AFFORDABILITY_COLUMNS = [
    "region_name", "region_name_dst", "period_year", "avg_annual_price_index",
    "avg_yoy_price_change_pct", "quarters_with_data", "total_gross_unemployment",
    "avg_disposable_income_dkk", "municipality_count", "avg_annual_price_mdkk",
    "annual_sales_count", "price_to_income_ratio"]


def annual_housing(fct_housing: DataFrame) -> DataFrame:
    """A9 quarter -> year: periods without an index value are dropped before counting."""
    return (fct_housing.where(F.col("price_index").isNotNull())
            .groupBy("region_name", "region_name_dst", "period_year")
            .agg(round_half_up(exact_avg("price_index"), 1).alias("avg_annual_price_index"),
                 round_half_up(exact_avg("pct_change_yoy"), 2).alias("avg_yoy_price_change_pct"),
                 F.count(F.lit(1)).alias("quarters_with_data")))


def annual_regional_prices(src_price_regional: DataFrame) -> DataFrame:
    """A9 month -> year with unit scaling (thousands -> millions, P13)."""
    return (src_price_regional.where(F.col("avg_price_dkk_1000").isNotNull())
            .groupBy(F.col("region_name").alias("_rp_region"), F.col("period_year").alias("_rp_year"))
            .agg(round_half_up(exact_avg("avg_price_dkk_1000") / 1000, 2).alias("avg_annual_price_mdkk"),
                 exact_sum("sales_count").alias("annual_sales_count")))


def mart_housing_affordability(fct_housing: DataFrame, fct_labour: DataFrame,
                               src_price_regional: DataFrame) -> DataFrame:
    """M9: annual price index (+ labour facts, J4) (+ annual absolute prices on the other
    region naming, J5) and the guarded price-to-income ratio (P14)."""
    h = annual_housing(fct_housing)
    lab = fct_labour.select(F.col("region_name").alias("_l_region"), F.col("period_year").alias("_l_year"),
                            "total_gross_unemployment",
                            F.col("avg_disposable_income_dkk").alias("_income"),
                            "municipality_count")
    rp = annual_regional_prices(src_price_regional)
    j = (h.join(lab, (F.col("region_name") == F.col("_l_region")) & (F.col("period_year") == F.col("_l_year")),
                "left")
         .join(rp, (F.col("region_name_dst") == F.col("_rp_region")) & (F.col("period_year") == F.col("_rp_year")),
               "left"))
    return j.select(
        "region_name", "region_name_dst", "period_year", "avg_annual_price_index",
        "avg_yoy_price_change_pct", "quarters_with_data", "total_gross_unemployment",
        round_half_up("_income", 0).alias("avg_disposable_income_dkk"),
        "municipality_count", "avg_annual_price_mdkk", "annual_sales_count",
        # rounded price (millions) over the unrounded income, as the original metric
        safe_ratio("avg_annual_price_mdkk", "_income", scale=1_000_000, digits=2)
        .alias("price_to_income_ratio"))


def mart_labour_housing_correlation(mart: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Affordability tier (P9), completeness (P10) and full-year (P11) flags."""
    return (mart.where(F.col("region_name").isNotNull())
            .select(*AFFORDABILITY_COLUMNS,
                    band("price_to_income_ratio", cfg.tiers, cfg.tier_else).alias("affordability_tier"),
                    all_not_null("total_gross_unemployment", "avg_annual_price_mdkk",
                                 "avg_disposable_income_dkk", "price_to_income_ratio")
                    .alias("has_full_data"),
                    equals_flag("quarters_with_data", cfg.periods_per_year).alias("is_full_year")))


def price_trend_ranking(mart: DataFrame) -> DataFrame:
    """Per year and region the average price, ratio and area count, ranked within the year
    by price, highest first with unknown prices ahead (W1), ordered by year and rank (O1)."""
    trends = mart.groupBy("period_year", "region_name").agg(
        round_half_up(exact_avg("avg_annual_price_mdkk"), 2).alias("avg_price_mdkk"),
        round_half_up(exact_avg("price_to_income_ratio"), 2).alias("avg_price_to_income_ratio"),
        F.count_distinct("region_name_dst").alias("n_areas"))
    w = Window.partitionBy("period_year").orderBy(F.col("avg_price_mdkk").desc_nulls_first())
    return (trends.withColumn("price_rank", F.rank().over(w))
            .orderBy("period_year", "price_rank", "region_name"))


def unemployment_price_correlation(corr_mart: DataFrame) -> DataFrame:
    """Per region, correlation over the years of unemployment with the same year's and the
    next year's price change, and with the price level.  The lag is a join on year - 1, so a gap
    year gives no pair instead of a wrong one (W2)."""
    base = corr_mart.select("region_name", "period_year", "total_gross_unemployment",
                            "avg_yoy_price_change_pct", "avg_annual_price_index")
    prev = base.select(F.col("region_name").alias("_p_region"),
                       (F.col("period_year") + 1).alias("_p_year"),
                       F.col("total_gross_unemployment").alias("prev_unemployment"))
    lagged = base.join(prev, (F.col("region_name") == F.col("_p_region"))
                       & (F.col("period_year") == F.col("_p_year")), "left")
    return lagged.groupBy("region_name").agg(
        F.count(F.lit(1)).alias("n_years"),
        round_half_up(F.corr("total_gross_unemployment", "avg_yoy_price_change_pct"), 6)
        .alias("corr_unemployment_price_change"),
        round_half_up(F.corr("prev_unemployment", "avg_yoy_price_change_pct"), 6)
        .alias("corr_lagged_unemployment_price_change"),
        round_half_up(F.corr("total_gross_unemployment", "avg_annual_price_index"), 6)
        .alias("corr_unemployment_price_level"))
