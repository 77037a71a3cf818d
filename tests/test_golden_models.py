"""Hand-worked expectations for the staging and core models on the golden micro-fixture."""

from fixtures import CFG, raw_frames, seed_frame
from keyfig.plans.pipeline import Pipeline


def pipe(spark):
    return Pipeline(spark, cfg=CFG, raw=raw_frames(spark), seed=seed_frame(spark))


def test_m1_price_index_pivot(spark):
    rows = {(r["region_name"], r["property_category"], r["period_quarter"]): r
            for r in pipe(spark).src_price_index.collect()}
    # provinces are dropped by the area list; the other category and the total are kept
    assert ("Province X", "One-family houses", "2023Q1") not in rows
    assert ("RA", "Owner-occupied flats", "2023Q1") in rows and ("All Denmark", "One-family houses", "2023Q1") in rows
    q1, q3 = rows[("RA", "One-family houses", "2023Q1")], rows[("RA", "One-family houses", "2023Q3")]
    assert (q1["price_index"], q1["pct_change_yoy"], q1["pct_change_qoq"]) == (100.0, 1.0, None)
    assert (q3["price_index"], q3["pct_change_yoy"]) == (None, None)
    assert (q1["period_year"], q1["period_quarter_num"]) == (2023, 1)
    assert len(rows) == 10


def test_m2_regional_prices(spark):
    rows = {(r["region_name"], r["period_month"]): r for r in pipe(spark).src_price_regional.collect()}
    assert rows[("RA", "2023M03")]["avg_price_dkk_1000"] is None and rows[("RA", "2023M03")]["sales_count"] == 3.0
    assert rows[("RB", "2023M01")]["avg_price_dkk_1000"] == 1675.0
    assert rows[("RA", "2023M02")]["period_month_num"] == 2


def test_m3_m4_staged_counts_and_income(spark):
    p = pipe(spark)
    u = {r["area_name"]: r["gross_unemployment_count"] for r in p.src_unemployment.collect()}
    # Westby is suppressed (dropped); regions and the total are kept at staging
    assert u == {"Northby": 120.0, "Eastby": 80.0, "Region A": 200.0, "All Denmark": 260.0}
    i = {r["municipality_name"]: r["avg_disposable_income_dkk"] for r in p.src_local_income.collect()}
    assert i == {"Northby": 250000.0, "Eastby": 260000.0, "Westby": 240000.0}


def test_m6_dimension(spark):
    d = {r["municipality_name"]: r["region_name_dst"] for r in pipe(spark).dim_municipalities.collect()}
    assert d == {"Northby": "RA", "Eastby": "RA", "Westby": "RB"}


def test_m7_housing_fact(spark):
    rows = pipe(spark).fct_housing_prices.collect()
    assert {r["region_name_dst"] for r in rows} == {"RA", "RB"}      # total dropped, flats filtered
    assert {r["region_name"] for r in rows} == {"Region A", "Region B"}
    assert len(rows) == 8


def test_m8_labour_fact(spark):
    rows = {r["region_name"]: r for r in pipe(spark).fct_labour_market_regional.collect()}
    a, b = rows["Region A"], rows["Region B"]
    assert (a["total_gross_unemployment"], a["avg_disposable_income_dkk"], a["municipality_count"]) == (200.0, 255000.0, 2)
    assert (b["total_gross_unemployment"], b["avg_disposable_income_dkk"], b["municipality_count"]) == (None, 240000.0, 1)
    assert a["_loaded_at"] is not None
