"""Pipeline configuration.

The pipeline is generic over the labels of the statistics tables.  ``REFERENCE`` holds the
labels of the original housing/labour tables; ``TPCH`` holds the labels that the test-table
binding (``keyfig.sources.binding``) produces from the shared TPC-H-style tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RawSpec:
    """Column layout of one raw (bronze) long-format table."""

    name: str
    dims: tuple[str, ...]          # dimension columns in source order, period last
    period: str = "TID"
    value: str = "INDHOLD"
    loaded_at: str = "_LOADED_AT"
    src_table: str = "_SRC_TABLE"
    decimal_comma: bool = True     # the extracts are written with decimal commas

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.dims, self.period, self.value)


# Raw table layouts (column names as delivered by the statistics API).
RAW_PRICE_INDEX = RawSpec("RAW_PRICE_INDEX", ("OMRÅDE", "EJENDOMSKATE", "TAL"))
RAW_PRICE_REGIONAL = RawSpec("RAW_PRICE_REGIONAL", ("REGION", "EJENDOMSKATE", "BNØGLE"))
RAW_UNEMPLOYMENT = RawSpec("RAW_UNEMPLOYMENT", ("YDELSESTYPE", "OMRÅDE"))
RAW_LOCAL_INCOME = RawSpec("RAW_LOCAL_INCOME", ("OMRÅDE", "ENHED", "INDKOMSTTYPE"))
RAW_HOUSING_NATIONAL = RawSpec("RAW_HOUSING_NATIONAL", ("EJENDOMSKATE", "BNØGLE"))
RAW_SPECS = (RAW_PRICE_INDEX, RAW_PRICE_REGIONAL, RAW_UNEMPLOYMENT, RAW_LOCAL_INCOME,
             RAW_HOUSING_NATIONAL)

# Statistics-API table id of each raw table.
SOURCE_IDS = {
    "RAW_PRICE_INDEX": "EJ56",
    "RAW_PRICE_REGIONAL": "EJ131",
    "RAW_UNEMPLOYMENT": "AUL01",
    "RAW_LOCAL_INCOME": "INDKP101",
    "RAW_HOUSING_NATIONAL": "LABY22",
}

# Suppression markers treated as NULL.  '..' (suppressed) and ':' (missing) are
# the statistics API's own; '', '<NA>', 'nan' are what stringified missing values look like.
DEFAULT_SENTINELS = ("..", ":", "", "<NA>", "nan")

# Affordability bands (strictly greater than the bound), highest first.
DEFAULT_TIERS = ((10.0, "HIGH_UNAFFORDABILITY"), (7.0, "MODERATE_UNAFFORDABILITY"))
DEFAULT_TIER_ELSE = "AFFORDABLE"


@dataclass(frozen=True)
class PipelineConfig:
    price_index_areas: tuple[str, ...]
    total_area: str
    category: str
    price_index_metrics: dict[str, str]
    price_regional_metrics: dict[str, str]
    housing_national_metrics: dict[str, str]
    unemployment_type: str
    income_unit: str
    income_type: str
    region_local_names: dict[str, str]
    periods_per_year: int = 4
    sentinels: tuple[str, ...] = DEFAULT_SENTINELS
    tiers: tuple[tuple[float, str], ...] = DEFAULT_TIERS
    tier_else: str = DEFAULT_TIER_ELSE
    # "latest": newest load wins per cell (fixes appended full extracts);
    # "max": largest value across loads, the original models' literal behaviour.
    resolve: str = "latest"
    freshness: dict[str, tuple[int, int]] = field(default_factory=dict)


# Labels of the original statistics tables.
REFERENCE = PipelineConfig(
    price_index_areas=(
        "All Denmark",
        "Region Hovedstaden",
        "Region Midtjylland",
        "Region Nordjylland",
        "Region Sjælland",
        "Region Syddanmark",
    ),
    total_area="All Denmark",
    category="One-family houses",
    price_index_metrics={
        "Index": "price_index",
        "Percentage change compared to previous quarter": "pct_change_qoq",
        "Percentage change compared to same quarter the year before": "pct_change_yoy",
    },
    price_regional_metrics={
        "Average price per property (dkk 1000)": "avg_price_dkk_1000",
        "Sales in the price calculation (number)": "sales_count",
        "Purchase sum in percent of taxable value": "purchase_sum_pct_taxable",
        "Estimated number of sales": "estimated_sales_count",
    },
    housing_national_metrics={
        "Average price per property (DKK 1,000)": "avg_price_per_property_dkk_1000",
        "Average price per square meter per property (DKK per m2)": "avg_price_per_m2_dkk",
        "Average age at which all buyers are first-time buyers (age)": "first_time_buyer_avg_age",
        "Estimated number of sales": "estimated_sales_count",
    },
    unemployment_type="Gross unemployment",
    income_unit="Average income for all people (DKK)",
    income_type="1 Disposable income (2+30-31-32-35)",
    region_local_names={
        "Capital Region of Denmark": "Region Hovedstaden",
        "Region Zealand": "Region Sjælland",
        "Region of Southern Denmark": "Region Syddanmark",
        "Central Denmark Region": "Region Midtjylland",
        "North Denmark Region": "Region Nordjylland",
    },
    # Source freshness (warn days, error days).
    freshness={
        "RAW_PRICE_INDEX": (100, 200),
        "RAW_PRICE_REGIONAL": (40, 70),
        "RAW_UNEMPLOYMENT": (400, 500),
        "RAW_LOCAL_INCOME": (400, 500),
        "RAW_HOUSING_NATIONAL": (400, 500),
    },
)


# Labels produced by the binding of the shared test tables (see keyfig.sources.binding):
# regions are TPC-H regions, "municipalities" are customers, categories are market segments,
# metric members are order priorities, benefit types are order statuses.
TPCH_REGION_LOCAL_NAMES = {
    "AFRICA": "Region Africa",
    "AMERICA": "Region America",
    "ASIA": "Region Asia",
    "EUROPE": "Region Europe",
    "MIDDLE EAST": "Region Middle East",
}
TPCH_TOTAL = "All regions"

TPCH = PipelineConfig(
    price_index_areas=(TPCH_TOTAL, *TPCH_REGION_LOCAL_NAMES.values()),
    total_area=TPCH_TOTAL,
    category="BUILDING",
    price_index_metrics={
        "1-URGENT": "price_index",
        "2-HIGH": "pct_change_qoq",
        "3-MEDIUM": "pct_change_yoy",
    },
    price_regional_metrics={
        "1-URGENT": "avg_price_dkk_1000",
        "2-HIGH": "sales_count",
        "3-MEDIUM": "purchase_sum_pct_taxable",
        "4-NOT SPECIFIED": "estimated_sales_count",
    },
    housing_national_metrics={
        "1-URGENT": "avg_price_per_property_dkk_1000",
        "2-HIGH": "avg_price_per_m2_dkk",
        "3-MEDIUM": "first_time_buyer_avg_age",
        "4-NOT SPECIFIED": "estimated_sales_count",
    },
    unemployment_type="F",
    income_unit="Average income (DKK)",
    income_type="1-URGENT",
    region_local_names=TPCH_REGION_LOCAL_NAMES,
    freshness=REFERENCE.freshness,
)
