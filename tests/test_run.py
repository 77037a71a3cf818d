"""The orchestrated pipeline: two runs (initial load, then a revision) equal a full rebuild."""

from fixtures import CFG, HOUSE, IDX, LOAD_1, LOAD_2, price_index_rows, raw_frame, raw_frames, seed_frame
from keyfig.plans.run import full_rebuild, run_pipeline, source_freshness


def rows(df):
    return sorted(map(lambda r: tuple(r), df.collect()), key=repr)


def test_two_runs_equal_full_rebuild(spark, tmp_path):
    wh = str(tmp_path / "wh")
    first = raw_frames(spark)
    r1 = run_pipeline(spark, first, seed_frame(spark), wh, CFG, "2024-01-01 07:00:00", ("Region A", "Region B"))
    m1 = {r["region_name"]: r for r in r1.mart_labour_housing_correlation.collect()}
    assert m1["Region A"]["avg_annual_price_index"] == 102.2
    assert r1.checks.where("status = 'fail'").count() == 0

    revised = [r if not (r[0] == "RA" and r[2] == IDX and r[3] == "2023Q1") else ("RA", HOUSE, IDX, "2023Q1", "98,0")
               for r in price_index_rows()]
    second = {"RAW_PRICE_INDEX": raw_frame(spark, "RAW_PRICE_INDEX", revised, LOAD_2),
              "RAW_UNEMPLOYMENT": raw_frame(spark, "RAW_UNEMPLOYMENT",
                                            [("Gross unemployment", "Northby", "2023", "130")], LOAD_2)}
    r2 = run_pipeline(spark, second, seed_frame(spark), wh, CFG, "2024-01-02 07:00:00", ("Region A", "Region B"))
    m2 = {r["region_name"]: r for r in r2.mart_labour_housing_correlation.collect()}
    assert m2["Region A"]["avg_annual_price_index"] == 101.5
    assert m2["Region A"]["total_gross_unemployment"] == 210

    all_raw = {k: first[k].unionByName(second[k]) if k in second else first[k] for k in first}
    assert rows(r2.mart_labour_housing_correlation) == rows(full_rebuild(all_raw, seed_frame(spark), CFG))
    # known from the loads' manifests, without a look at the data
    fresh = {r["source_name"]: str(r["max_loaded_at"]) for r in source_freshness(spark, wh, CFG, "2024-01-03 06:00:00").collect()}
    assert fresh["RAW_UNEMPLOYMENT"] == LOAD_2 and fresh["RAW_LOCAL_INCOME"] == LOAD_1
    # the run again, as after a crash: its loads are there once, nothing changes
    r3 = run_pipeline(spark, second, seed_frame(spark), wh, CFG, "2024-01-02 07:00:00", ("Region A", "Region B"))
    assert rows(r3.mart_labour_housing_correlation) == rows(r2.mart_labour_housing_correlation)
    assert r3.raw_rows_landed == r2.raw_rows_landed and rows(r3.municipality_history) == rows(r2.municipality_history)
    # the dimension did not change: one open version per municipality
    assert r2.municipality_history.where("valid_to IS NULL").count() == 3


def test_a_failed_check_leaves_the_previous_facts(spark, tmp_path):
    import pytest
    from keyfig.operators import partitions
    from keyfig.plans import refresh
    wh = str(tmp_path / "wh")
    first = raw_frames(spark)
    r1 = run_pipeline(spark, first, seed_frame(spark), wh, CFG, "2024-01-01 07:00:00", ("Region A", "Region B"))
    before, schema = rows(r1.fct_labour_market_regional), r1.fct_labour_market_regional.schema
    bad = {"RAW_LOCAL_INCOME": raw_frame(spark, "RAW_LOCAL_INCOME", [
        ("Northby", "Average income for all people (DKK)", "1 Disposable income (2+30-31-32-35)", "2023", "-5")], LOAD_2)}
    with pytest.raises(RuntimeError, match="avg_disposable_income_dkk"):
        run_pipeline(spark, bad, seed_frame(spark), wh, CFG, "2024-01-02 07:00:00", ("Region A", "Region B"))
    now = partitions.read(spark, f"{wh}/fct_labour_market_regional", schema, refresh.PARTITION)
    assert rows(now) == before


def test_a_missing_source_stops_nothing(spark, tmp_path):
    some = {k: v for k, v in raw_frames(spark).items() if k not in ("RAW_PRICE_REGIONAL", "RAW_HOUSING_NATIONAL")}
    some["RAW_UNEMPLOYMENT"] = some["RAW_UNEMPLOYMENT"].unionByName(
        raw_frame(spark, "RAW_UNEMPLOYMENT", [("Gross unemployment", "Nowhereby", "2023", "7")]))
    r = run_pipeline(spark, some, seed_frame(spark), str(tmp_path / "wh"), CFG, "2024-01-01 07:00:00", ("Region A", "Region B"))
    m = {x["region_name"]: x for x in spark.table("mart_labour_housing_correlation").collect()}
    assert m["Region A"]["avg_annual_price_index"] == 102.2 and m["Region A"]["avg_annual_price_mdkk"] is None
    lost = r.checks.where("check_name = 'unmatched_names' AND model = 'src_unemployment'").first()
    assert (lost["failures"], lost["status"]) == (1, "warn")
