"""The pipeline wired together: raw extracts -> staging -> core -> marts, as one lazy plan.

``Pipeline`` only memoises DataFrame *definitions* (no caching of data): Catalyst plans every
query end to end from the Parquet scans, pruning what a query does not use.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from keyfig.plans import core, marts, staging
from keyfig.plans.config import (RAW_HOUSING_NATIONAL, RAW_LOCAL_INCOME, RAW_PRICE_INDEX,
                                 RAW_PRICE_REGIONAL, RAW_UNEMPLOYMENT, TPCH, PipelineConfig)
from keyfig.sources import binding


class Pipeline:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 cfg: PipelineConfig = TPCH, raw: dict[str, DataFrame] | None = None,
                 seed: DataFrame | None = None):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, cfg
        self._raw = dict(raw or {})
        self._seed = seed

    # -- inputs ---------------------------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = binding.RAW_BUILDERS[name](self.spark, self.sf_dir)
        return self._raw[name]

    @property
    def seed(self) -> DataFrame:
        if self._seed is None:
            self._seed = binding.municipality_seed(self.spark, self.sf_dir)
        return self._seed

    # -- staging --------------------------------------------------------------------------
    @cached_property
    def src_price_index(self) -> DataFrame:
        return staging.src_price_index(self.raw(RAW_PRICE_INDEX.name), self.cfg)

    @cached_property
    def src_price_regional(self) -> DataFrame:
        return staging.src_price_regional(self.raw(RAW_PRICE_REGIONAL.name), self.cfg)

    @cached_property
    def src_unemployment(self) -> DataFrame:
        return staging.src_unemployment(self.raw(RAW_UNEMPLOYMENT.name), self.cfg)

    @cached_property
    def src_local_income(self) -> DataFrame:
        return staging.src_local_income(self.raw(RAW_LOCAL_INCOME.name), self.cfg)

    @cached_property
    def src_housing_national(self) -> DataFrame:
        return staging.src_housing_national(self.raw(RAW_HOUSING_NATIONAL.name), self.cfg)

    # -- core -----------------------------------------------------------------------------
    @cached_property
    def dim_municipalities(self) -> DataFrame:
        return core.dim_municipalities(self.seed, self.cfg)

    @cached_property
    def fct_housing_prices(self) -> DataFrame:
        return core.fct_housing_prices(self.src_price_index, self.dim_municipalities, self.cfg)

    @cached_property
    def fct_labour_market_regional(self) -> DataFrame:
        return core.fct_labour_market_regional(self.src_unemployment, self.src_local_income,
                                               self.dim_municipalities)

    # -- marts ----------------------------------------------------------------------------
    @cached_property
    def mart_housing_affordability(self) -> DataFrame:
        return marts.mart_housing_affordability(self.fct_housing_prices,
                                                self.fct_labour_market_regional,
                                                self.src_price_regional)

    @cached_property
    def mart_labour_housing_correlation(self) -> DataFrame:
        return marts.mart_labour_housing_correlation(self.mart_housing_affordability, self.cfg)

    @cached_property
    def price_trend_ranking(self) -> DataFrame:
        return marts.price_trend_ranking(self.mart_housing_affordability)

    @cached_property
    def unemployment_price_correlation(self) -> DataFrame:
        return marts.unemployment_price_correlation(self.mart_labour_housing_correlation)
