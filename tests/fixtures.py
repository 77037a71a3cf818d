"""Golden micro-fixture: hand-written raw extracts with the original tables' labels."""

from __future__ import annotations

from dataclasses import replace

from keyfig.plans.config import REFERENCE, RAW_SPECS

LOAD_1 = "2024-01-01 06:00:00"
LOAD_2 = "2024-01-02 06:00:00"

CFG = replace(
    REFERENCE,
    price_index_areas=("All Denmark", "RA", "RB"),
    region_local_names={"Region A": "RA", "Region B": "RB"},
)
IDX = "Index"
YOY = "Percentage change compared to same quarter the year before"
HOUSE = "One-family houses"
PRICE = "Average price per property (dkk 1000)"
SALES = "Sales in the price calculation (number)"
GROSS = "Gross unemployment"
UNIT = "Average income for all people (DKK)"
KIND = "1 Disposable income (2+30-31-32-35)"

SEED = [(1, "Northby", 1, "Region A"), (2, "Eastby", 1, "Region A"), (3, "Westby", 2, "Region B")]


def price_index_rows():
    rows = []
    for q, idx, yoy in zip((1, 2, 3, 4), ("100,0", "102,5", "..", "104,1"), ("1,0", "2,0", "..", "3,5")):
        rows += [("RA", HOUSE, IDX, f"2023Q{q}", idx), ("RA", HOUSE, YOY, f"2023Q{q}", yoy)]
    for q, idx in zip((1, 2, 3, 4), ("90.0", "91.0", "92.0", "93.0")):
        rows += [("RB", HOUSE, IDX, f"2023Q{q}", idx), ("RB", HOUSE, YOY, f"2023Q{q}", "..")]
    rows += [("All Denmark", HOUSE, IDX, "2023Q1", "95,0"),          # national total
             ("Province X", HOUSE, IDX, "2023Q1", "70,0"),           # dropped by the area list
             ("RA", "Owner-occupied flats", IDX, "2023Q1", "150,0")]  # another category
    return rows


def price_regional_rows():
    return [("RA", HOUSE, PRICE, "2023M01", "2500.0"), ("RA", HOUSE, PRICE, "2023M02", "2600.0"),
            ("RA", HOUSE, PRICE, "2023M03", ".."), ("RB", HOUSE, PRICE, "2023M01", "1675.0"),
            ("RA", HOUSE, SALES, "2023M01", "10"), ("RA", HOUSE, SALES, "2023M02", "12"),
            ("RA", HOUSE, SALES, "2023M03", "3"), ("RB", HOUSE, SALES, "2023M01", "5")]


def unemployment_rows():
    return [(GROSS, "Northby", "2023", "120"), (GROSS, "Eastby", "2023", "80"),
            (GROSS, "Westby", "2023", ".."), (GROSS, "Region A", "2023", "200"),
            (GROSS, "All Denmark", "2023", "260"), ("Net unemployment", "Northby", "2023", "99")]


def income_rows():
    return [("Northby", UNIT, KIND, "2023", "250000"), ("Eastby", UNIT, KIND, "2023", "260000"),
            ("Westby", UNIT, KIND, "2023", "240000"), ("Northby", "People (number)", KIND, "2023", "5000")]


ROWS = {"RAW_PRICE_INDEX": price_index_rows, "RAW_PRICE_REGIONAL": price_regional_rows,
        "RAW_UNEMPLOYMENT": unemployment_rows, "RAW_LOCAL_INCOME": income_rows,
        "RAW_HOUSING_NATIONAL": lambda: [(HOUSE, "Estimated number of sales", "2023", "123")]}


def raw_frame(spark, name: str, rows=None, loaded_at: str = LOAD_1):
    from pyspark.sql import functions as F
    spec = next(s for s in RAW_SPECS if s.name == name)
    schema = ", ".join(f"`{c}` string" for c in spec.columns)
    df = spark.createDataFrame(rows if rows is not None else ROWS[name](), schema)
    return df.withColumns({"_LOADED_AT": F.lit(loaded_at).cast("timestamp_ntz"),
                           "_SRC_TABLE": F.lit(name)})


def raw_frames(spark, loaded_at: str = LOAD_1):
    return {name: raw_frame(spark, name, loaded_at=loaded_at) for name in ROWS}


def seed_frame(spark, rows=SEED):
    return spark.createDataFrame(
        rows, "municipality_code int, municipality_name string, region_code int, region_name string")
