"""Incremental refresh of the two facts (M7, M8 with I1, I2, I5, I6).

A refresh gets the rows of the loads that were not applied yet.  It finds the groups they touch,
rebuilds exactly those groups from the *whole* raw history with latest-load semantics, and
returns the new content of the fact partitions (``period_year``) that change.  So a partial
batch -- one municipality, one metric, one source -- can never blank or shrink a group that it
only partly re-delivers, and k incremental runs in any order equal one full build.

The raw history is cut to the touched periods by a filter on the period column (a partition
filter where it is the partition column) and to the touched cells by a semi join *below* the
latest-load aggregation, so the work follows the batch and not the history.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfig.functions.columns import period_year, surrogate_key
from keyfig.operators.incremental import affected_groups, cells_of_groups
from keyfig.operators.partitions import values_of
from keyfig.plans import core, staging
from keyfig.plans.config import PipelineConfig

PARTITION = "period_year"


class Change(NamedTuple):
    """New content of the partitions of ``years``."""

    rows: DataFrame
    years: list[int]


def _year(tid: str) -> Column:
    return F.left(F.trim(F.col(tid)), F.lit(4)).try_cast("int")


def _periods(raw: DataFrame, years: list[int]) -> DataFrame:
    return raw.where(_year("TID").isin(years))


def _semi(df: DataFrame, keys: DataFrame, cond: Column) -> DataFrame:
    """Semi join with the touched keys.  Their number is only known at run time, so the choice
    is AQE's: it broadcasts the side once its measured size is small, else keeps the shuffle."""
    return df.join(keys, cond, "left_semi")


def refresh_housing(target: DataFrame | None, raw_price_index: DataFrame, new_rows: DataFrame,
                    dim: DataFrame, cfg: PipelineConfig) -> Change:
    """M7 after new loads: rebuild the (area, category, quarter) cells that they touch."""
    if target is None:
        fact = core.fct_housing_prices(staging.src_price_index(raw_price_index, cfg), dim, cfg)
        return Change(fact, values_of(fact, PARTITION))
    touched = new_rows.select(F.col("OMRÅDE").alias("_a"), F.col("EJENDOMSKATE").alias("_c"),
                              F.col("TID").alias("_t"), _year("TID").alias("_y")).distinct()
    years = values_of(touched, "_y")
    cells = _semi(_periods(raw_price_index, years), touched, (F.col("OMRÅDE") == F.col("_a"))
                  & (F.col("EJENDOMSKATE") == F.col("_c")) & (F.col("TID") == F.col("_t")))
    fresh = core.fct_housing_prices(staging.src_price_index(cells, cfg), dim, cfg)
    old = target.where(F.col(PARTITION).isin(years))
    kept = old.join(touched, (F.col("region_name_dst") == F.col("_a")) & (F.col("property_category") == F.col("_c"))
                    & (F.col("period_quarter") == F.col("_t")), "left_anti")
    return Change(kept.unionByName(fresh), years)


HOUSING_KEYS = ["price_index_id"]


def housing_change(raw_price_index: DataFrame, new_rows: DataFrame, dim: DataFrame, cfg: PipelineConfig) -> tuple[DataFrame, DataFrame]:
    """The rows of the cells that new loads touch, and the keys of all these cells.

    A change of a keyed table (:mod:`keyfig.operators.changes`): the table itself is not read, and
    the bytes written follow the touched cells; a cell that has lost its values goes."""
    touched = (new_rows.where(F.col("OMRÅDE").isin(list(cfg.price_index_areas)) & (F.col("EJENDOMSKATE") == F.lit(cfg.category)))
               .select(F.col("OMRÅDE").alias("_a"), F.col("EJENDOMSKATE").alias("_c"), F.col("TID").alias("_t"), _year("TID").alias("_y")).distinct())
    years = values_of(touched, "_y")
    cells = _semi(_periods(raw_price_index, years), touched, (F.col("OMRÅDE") == F.col("_a"))
                  & (F.col("EJENDOMSKATE") == F.col("_c")) & (F.col("TID") == F.col("_t")))
    fresh = core.fct_housing_prices(staging.src_price_index(cells, cfg), dim, cfg)
    keys = touched.select(surrogate_key("_a", "_c", "_t").alias("price_index_id"), period_year("_t").alias(PARTITION))
    return fresh, keys


def refresh_labour(target: DataFrame | None, raw_unemployment: DataFrame, raw_income: DataFrame,
                   new_unemployment: DataFrame, new_income: DataFrame, dim: DataFrame,
                   cfg: PipelineConfig) -> Change:
    """M8 after new loads (I6): recompute every (region, year) with a new child row, from all
    of that group's children; groups left without data disappear, as in a full build."""
    if target is None:
        fact = core.fct_labour_market_regional(staging.src_unemployment(raw_unemployment, cfg),
                                               staging.src_local_income(raw_income, cfg), dim)
        return Change(fact, values_of(fact, PARTITION))
    touched = (new_unemployment.where(F.col("YDELSESTYPE") == F.lit(cfg.unemployment_type))
               .unionByName(new_income.where((F.col("ENHED") == F.lit(cfg.income_unit))
                                             & (F.col("INDKOMSTTYPE") == F.lit(cfg.income_type))),
                            allowMissingColumns=True)
               .select(F.col("OMRÅDE").alias("area"), _year("TID").alias("period_year")).distinct())
    groups = affected_groups(touched, "area", "period_year", dim)
    years = values_of(groups, "period_year")
    cells = cells_of_groups(groups, dim)
    inside = (F.col("OMRÅDE") == F.col("_child")) & (_year("TID") == F.col("_year"))
    fresh = core.fct_labour_market_regional(
        staging.src_unemployment(_semi(_periods(raw_unemployment, years), cells, inside), cfg),
        staging.src_local_income(_semi(_periods(raw_income, years), cells, inside), cfg), dim)
    g = groups.select(F.col("region_name").alias("_gr"), F.col("period_year").alias("_gy"))
    kept = target.where(F.col(PARTITION).isin(years)).join(
        g, (F.col("region_name") == F.col("_gr")) & (F.col("period_year") == F.col("_gy")), "left_anti")
    return Change(kept.unionByName(fresh.select(*target.columns)), years)
