"""The registered queries against their SQL, and the pipeline against plain Python."""

import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from plain import line_dedup, near_duplicates

import __spark_entry__ as entry
from keyfig.llm import decontaminate, langid, packing
from keyfig.llm.queries import QUERIES, SQL


def test_all_are_registered():
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF_SMALL), con.sql(SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    row = lambda names, r: tuple(r[names.index(c)] for c in columns)
    assert sorted((row(got.columns, tuple(r)) for r in got.collect()), key=str) == sorted((row(want.columns, r) for r in want.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_covers_its_table(spark, name):
    table, key = ("pages", "page_id") if "html" in name else ("documents", "doc_id")
    ids = {r[0] for r in spark.read.parquet(f"{SF_SMALL}/{table}.parquet").select(key).collect()}
    rows = [r[0] for r in QUERIES[name](spark, SF_SMALL).select(key).collect()]
    assert set(rows) == ids and (len(rows) == len(ids) or "packing" in name)


def test_pipeline_equals_plain_python(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    model, limits = (f(spark.read.parquet(f"{SF_SMALL}/documents.parquet")) for f in (langid.fit, langid.limits))
    found = model.predict(pa.array([t for _, t in docs], pa.string())).to_pylist()

    def fits(x):
        if x["lang"] == "und" or x["lang"] not in limits:
            return x["lang"] != "und"
        usual, most = limits[x["lang"]]
        above = (x["bits"] / x["symbols"] - usual) * (x["symbols"] / (1 + x["symbols"] / langid.STEADY)) ** 0.5
        return x["bits"] < x["symbols"] * np.log2(langid.SYMBOLS) or above <= most

    docs = [d for d, x in zip(docs, found, strict=True) if fits(x)]
    cleaned = line_dedup(docs)
    docs = [(d, cleaned[d, t][0]) for d, t in docs if not cleaned[d, t][2] or cleaned[d, t][0].strip(" \n")]
    docs = [d for d, (i, c, links) in zip(docs, near_duplicates(docs), strict=True) if not links or i == c]
    hit = decontaminate.brute_force(docs, items)
    docs = [(d, t) for d, t in docs if not hit[d][1]]
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = Counter()
    for d, t in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for n, k in enumerate(range(0, len(ids), 4096)):
            want[d, n, k, len(ids[k:k + 4096]), zlib.crc32(np.array(ids[k:k + 4096], "<u4").tobytes())] += 1
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    assert len(corpus_pipeline.STAGES) == 5 and 100 < len(docs) < 200


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == 0
