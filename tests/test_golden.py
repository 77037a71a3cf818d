"""The hand-computed mart of FIXTURES.md section 3, and its variants."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtures import CFG, HOUSE, IDX, LOAD_2, price_index_rows, raw_frame, raw_frames, seed_frame
from keyfig.plans.pipeline import Pipeline
from keyfig.plans import core, refresh, staging


def mart(spark, raw=None, cfg=CFG):
    p = Pipeline(spark, cfg=cfg, raw=raw or raw_frames(spark), seed=seed_frame(spark))
    return {r["region_name"]: r.asDict() for r in p.mart_labour_housing_correlation.collect()}


def test_golden_mart(spark):
    m = mart(spark)
    a, b = m["Region A"], m["Region B"]
    assert a["avg_annual_price_index"] == 102.2 and b["avg_annual_price_index"] == 91.5
    assert a["avg_yoy_price_change_pct"] == 2.17 and b["avg_yoy_price_change_pct"] is None
    assert (a["quarters_with_data"], a["is_full_year"]) == (3, False)
    assert (b["quarters_with_data"], b["is_full_year"]) == (4, True)
    assert a["total_gross_unemployment"] == 200 and b["total_gross_unemployment"] is None
    assert a["avg_disposable_income_dkk"] == 255000 and b["avg_disposable_income_dkk"] == 240000
    assert a["municipality_count"] == 2 and b["municipality_count"] == 1
    assert a["avg_annual_price_mdkk"] == 2.55 and b["avg_annual_price_mdkk"] == 1.68
    assert a["annual_sales_count"] == 22 and b["annual_sales_count"] == 5
    assert a["price_to_income_ratio"] == 10.0 and b["price_to_income_ratio"] == 7.0
    assert a["affordability_tier"] == "MODERATE_UNAFFORDABILITY" and b["affordability_tier"] == "AFFORDABLE"
    assert a["has_full_data"] is True and b["has_full_data"] is False
    assert a["region_name_dst"] == "RA" and b["region_name_dst"] == "RB"


def _appended(spark, extra: dict[str, DataFrame]):
    base = raw_frames(spark)
    return {k: base[k].unionByName(extra[k]) if k in extra else base[k] for k in base}


def test_reappend_same_load_is_idempotent(spark):
    again = {k: v.withColumn("_LOADED_AT", F.lit(LOAD_2).cast("timestamp_ntz"))
             for k, v in raw_frames(spark).items()}
    assert mart(spark, _appended(spark, again)) == mart(spark)


def test_revision_newest_load_wins(spark):
    rows = [r if not (r[0] == "RA" and r[2] == IDX and r[3] == "2023Q1") else ("RA", HOUSE, IDX, "2023Q1", "98,0")
            for r in price_index_rows()]
    second = raw_frame(spark, "RAW_PRICE_INDEX", rows, loaded_at=LOAD_2)
    m = mart(spark, _appended(spark, {"RAW_PRICE_INDEX": second}))
    assert m["Region A"]["avg_annual_price_index"] == 101.5


def test_literal_max_mode_keeps_largest(spark):
    from dataclasses import replace
    rows = [("RA", HOUSE, IDX, "2023Q1", "98,0")]
    second = raw_frame(spark, "RAW_PRICE_INDEX", rows, loaded_at=LOAD_2)
    m = mart(spark, _appended(spark, {"RAW_PRICE_INDEX": second}), cfg=replace(CFG, resolve="max"))
    assert m["Region A"]["avg_annual_price_index"] == 102.2


def test_partial_batch_recomputes_affected_group(spark):
    raw = raw_frames(spark)
    dim = core.dim_municipalities(seed_frame(spark), CFG)
    u, i = raw["RAW_UNEMPLOYMENT"], raw["RAW_LOCAL_INCOME"]
    target = refresh.refresh_labour(None, u, i, u, i, dim, CFG).rows
    batch = raw_frame(spark, "RAW_UNEMPLOYMENT", [("Gross unemployment", "Northby", "2023", "130")], LOAD_2)
    change = refresh.refresh_labour(target, u.unionByName(batch), i, batch, i.limit(0), dim, CFG)
    assert change.years == [2023]
    new = change.rows
    got = {r["region_name"]: r for r in new.collect()}
    assert got["Region A"]["total_gross_unemployment"] == 210
    assert got["Region A"]["avg_disposable_income_dkk"] == 255000
    assert got["Region B"]["avg_disposable_income_dkk"] == 240000
    # incremental == full rebuild
    full = core.fct_labour_market_regional(
        staging.src_unemployment(raw["RAW_UNEMPLOYMENT"].unionByName(batch), CFG),
        staging.src_local_income(raw["RAW_LOCAL_INCOME"], CFG), dim)
    assert sorted(map(tuple, new.drop("_loaded_at").collect())) == sorted(map(tuple, full.drop("_loaded_at").collect()))


def test_incremental_housing_equals_full_build(spark):
    raw = raw_frames(spark)
    dim = core.dim_municipalities(seed_frame(spark), CFG)
    target = refresh.refresh_housing(None, raw["RAW_PRICE_INDEX"], raw["RAW_PRICE_INDEX"], dim, CFG).rows
    batch = raw_frame(spark, "RAW_PRICE_INDEX", [("RA", HOUSE, IDX, "2023Q3", "103,0")], LOAD_2)
    allraw = raw["RAW_PRICE_INDEX"].unionByName(batch)
    inc = refresh.refresh_housing(target, allraw, batch, dim, CFG).rows
    full = refresh.refresh_housing(None, allraw, allraw, dim, CFG).rows
    assert sorted(map(tuple, inc.collect())) == sorted(map(tuple, full.collect()))
    q3 = inc.where("region_name_dst = 'RA' AND period_quarter = '2023Q3'").first()
    assert q3["price_index"] == 103.0 and q3["pct_change_yoy"] is None


def test_history_versions(spark):
    from keyfig.operators.history import snapshot
    v1 = seed_frame(spark)
    v2 = seed_frame(spark, [(1, "Northby", 1, "Region A"), (2, "Eastby", 2, "Region B"), (4, "Southby", 2, "Region B")])
    check = ["municipality_name", "region_code", "region_name"]
    h = snapshot(None, v1, "municipality_code", check, "2024-01-01 00:00:00")
    h = snapshot(h, v2, "municipality_code", check, "2024-02-01 00:00:00")
    rows = h.collect()
    by = {}
    for r in rows:
        by.setdefault(r["municipality_name"], []).append(r)
    assert len(by["Northby"]) == 1 and by["Northby"][0]["valid_to"] is None
    east = sorted(by["Eastby"], key=lambda r: r["valid_from"])
    assert len(east) == 2 and east[0]["valid_to"] is not None and east[1]["valid_to"] is None
    assert east[1]["region_name"] == "Region B"
    assert len(by["Westby"]) == 1 and by["Westby"][0]["valid_to"] is not None
    assert len(by["Southby"]) == 1 and by["Southby"][0]["valid_to"] is None
    # one open version per live key, and no key has overlapping intervals
    open_keys = [r["municipality_code"] for r in rows if r["valid_to"] is None]
    assert sorted(open_keys) == [1, 2, 4]
    # a key that comes back opens a fresh version
    h3 = snapshot(h, v1, "municipality_code", check, "2024-03-01 00:00:00")
    west = [r for r in h3.collect() if r["municipality_name"] == "Westby"]
    assert len(west) == 2 and sum(r["valid_to"] is None for r in west) == 1
