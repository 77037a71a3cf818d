"""The pipeline's declarative test suite (Q6): per model, the column checks to run after it is
built.  The same list drives :func:`keyfig.operators.quality.run_checks` and the oracle."""

from __future__ import annotations

from keyfig.operators.quality import Check
from keyfig.plans.config import PipelineConfig


def _nn(model: str, *cols: str) -> list[Check]:
    return [Check("not_null", model, c) for c in cols]


def suite(cfg: PipelineConfig, region_names: tuple[str, ...]) -> list[Check]:
    tiers = tuple(label for _, label in cfg.tiers) + (cfg.tier_else,)
    return [
        # seed
        Check("unique", "seed", "municipality_code"),
        *_nn("seed", "municipality_code", "municipality_name", "region_code", "region_name"),
        Check("accepted_values", "seed", "region_name", values=region_names),
        # staging
        Check("unique", "src_price_index", "price_index_id"),
        *_nn("src_price_index", "price_index_id", "region_name", "property_category", "period_quarter",
             "period_year"),
        Check("unique", "src_price_regional", "price_regional_id"),
        *_nn("src_price_regional", "price_regional_id", "region_name", "property_category",
             "period_month", "period_year"),
        Check("unique", "src_unemployment", "unemployment_id"),
        *_nn("src_unemployment", "unemployment_id", "area_name", "period_year",
             "gross_unemployment_count"),
        Check("between", "src_unemployment", "gross_unemployment_count", min_value=0),
        Check("unique", "src_local_income", "income_id"),
        *_nn("src_local_income", "income_id", "municipality_name", "period_year",
             "avg_disposable_income_dkk"),
        Check("between", "src_local_income", "avg_disposable_income_dkk", min_value=0,
              max_value=2_000_000),
        Check("unique", "src_housing_national", "housing_national_id"),
        *_nn("src_housing_national", "housing_national_id", "property_category", "period_year"),
        # core
        Check("unique", "dim_municipalities", "municipality_code"),
        *_nn("dim_municipalities", "municipality_code", "municipality_name", "region_name",
             "region_name_dst"),
        Check("accepted_values", "dim_municipalities", "region_name_dst",
              values=tuple(cfg.region_local_names.values())),
        Check("unique", "fct_housing_prices", "price_index_id"),
        *_nn("fct_housing_prices", "price_index_id", "region_name_dst", "region_name",
             "property_category", "period_quarter", "period_year"),
        Check("unique", "fct_labour_market_regional", "labour_regional_id"),
        *_nn("fct_labour_market_regional", "labour_regional_id", "region_name", "period_year"),
        # marts
        *_nn("mart_housing_affordability", "region_name", "period_year"),
        *_nn("mart_labour_housing_correlation", "region_name", "period_year"),
        Check("accepted_values", "mart_labour_housing_correlation", "affordability_tier", values=tiers),
    ]
