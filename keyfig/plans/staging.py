"""Staging models (M1-M5): raw text extracts -> typed, pivoted, keyed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfig.functions.columns import (parse_number, period_sub, period_year, strict_int,
                                      surrogate_key)
from keyfig.operators.reshape import latest_value, pivot_metrics
from keyfig.plans.config import (RAW_HOUSING_NATIONAL, RAW_LOCAL_INCOME, RAW_PRICE_INDEX,
                                 RAW_PRICE_REGIONAL, RAW_UNEMPLOYMENT, PipelineConfig)


def _value(spec, cfg: PipelineConfig):
    return parse_number(spec.value, decimal_comma=spec.decimal_comma,
                        sentinels=cfg.sentinels).alias("value")


def src_price_index(raw: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """M1: region x category x quarter; regions and the national total only (P5)."""
    s = RAW_PRICE_INDEX
    df = (raw.where(F.col("OMRÅDE").isin(list(cfg.price_index_areas)))
          .select(F.col("OMRÅDE").alias("region_name"),
                  F.col("EJENDOMSKATE").alias("property_category"),
                  F.col("TAL").alias("metric"),
                  F.col(s.period).alias("period_quarter"),
                  _value(s, cfg),
                  F.col(s.loaded_at).alias("loaded_at")))
    keys = ["region_name", "property_category", "period_quarter"]
    piv = pivot_metrics(df, keys, "metric", "value", cfg.price_index_metrics,
                        loaded_at="loaded_at", resolve=cfg.resolve)
    return piv.select(
        surrogate_key(*keys).alias("price_index_id"),
        *keys,
        period_year("period_quarter").alias("period_year"),
        period_sub("period_quarter", 1).alias("period_quarter_num"),
        *cfg.price_index_metrics.values(),
        "_loaded_at")


def src_price_regional(raw: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """M2: region x category x month for the configured category."""
    s = RAW_PRICE_REGIONAL
    df = (raw.where(F.col("EJENDOMSKATE") == F.lit(cfg.category))
          .select(F.col("REGION").alias("region_name"),
                  F.col("EJENDOMSKATE").alias("property_category"),
                  F.col("BNØGLE").alias("metric"),
                  F.col(s.period).alias("period_month"),
                  _value(s, cfg),
                  F.col(s.loaded_at).alias("loaded_at")))
    keys = ["region_name", "property_category", "period_month"]
    piv = pivot_metrics(df, keys, "metric", "value", cfg.price_regional_metrics,
                        loaded_at="loaded_at", resolve=cfg.resolve)
    return piv.select(
        surrogate_key(*keys).alias("price_regional_id"),
        *keys,
        period_year("period_month").alias("period_year"),
        period_sub("period_month", 2).alias("period_month_num"),
        *cfg.price_regional_metrics.values(),
        "_loaded_at")


def _latest(df: DataFrame, keys: list[str], cfg: PipelineConfig) -> DataFrame:
    return latest_value(df, keys, "value", "_loaded_at") if cfg.resolve == "latest" else df


def src_unemployment(raw: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """M3: area x year gross counts; municipalities, regions and totals all kept."""
    s = RAW_UNEMPLOYMENT
    df = (raw.where(F.col("YDELSESTYPE") == F.lit(cfg.unemployment_type))
          .select(F.col("OMRÅDE").alias("area_name"), F.col(s.period).alias("tid"),
                  _value(s, cfg), F.col(s.loaded_at).alias("_loaded_at")))
    df = _latest(df, ["area_name", "tid"], cfg)
    return (df.select(surrogate_key("area_name", "tid").alias("unemployment_id"),
                      "area_name",
                      strict_int("tid", "period year").alias("period_year"),
                      F.col("value").alias("gross_unemployment_count"),
                      "_loaded_at")
            .where(F.col("gross_unemployment_count").isNotNull()))


def src_local_income(raw: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """M4: municipality x year average disposable income."""
    s = RAW_LOCAL_INCOME
    df = (raw.where((F.col("ENHED") == F.lit(cfg.income_unit))
                    & (F.col("INDKOMSTTYPE") == F.lit(cfg.income_type)))
          .select(F.col("OMRÅDE").alias("municipality_name"), F.col(s.period).alias("tid"),
                  _value(s, cfg), F.col(s.loaded_at).alias("_loaded_at")))
    df = _latest(df, ["municipality_name", "tid"], cfg)
    return (df.select(surrogate_key("municipality_name", "tid").alias("income_id"),
                      "municipality_name",
                      strict_int("tid", "period year").alias("period_year"),
                      F.col("value").alias("avg_disposable_income_dkk"),
                      "_loaded_at")
            .where(F.col("avg_disposable_income_dkk").isNotNull()))


def src_housing_national(raw: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """M5: category x year national benchmarks."""
    s = RAW_HOUSING_NATIONAL
    df = (raw.where(F.col("EJENDOMSKATE") == F.lit(cfg.category))
          .select(F.col("EJENDOMSKATE").alias("property_category"),
                  F.col("BNØGLE").alias("metric"),
                  F.col(s.period).alias("tid"),
                  _value(s, cfg),
                  F.col(s.loaded_at).alias("loaded_at")))
    piv = pivot_metrics(df, ["property_category", "tid"], "metric", "value",
                        cfg.housing_national_metrics, loaded_at="loaded_at", resolve=cfg.resolve)
    piv = piv.withColumn("period_year", strict_int("tid", "period year"))
    return piv.select(
        surrogate_key("property_category", "period_year").alias("housing_national_id"),
        "property_category", "period_year",
        *cfg.housing_national_metrics.values(),
        "_loaded_at")
