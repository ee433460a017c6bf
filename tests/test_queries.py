"""Queries against their SQL, and the entry points."""

import numbers

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from sourceground.queries import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SOME = ["x01_strip_inline", "x08_ingredients", "p02_quality_percent", "s02_file_order", "w05_heading_path", "g02_generate_t6", "v08_validate", "r01_balanced_take", "j03_resume", "a01_pilot_stats", "d03_trace_spans", "g07_items_from_replies", "v04_model_formulas", "p12_item_violations", "p12_item_documents", "w01_split_lines", "st3_target_run"]


def rows(df):
    df = df[sorted(df.columns)]
    cell = lambda v: "" if v is None or v is pd.NA or v != v else round(float(v), 6) if isinstance(v, numbers.Number) and not isinstance(v, bool) else str(v)
    return sorted((tuple(cell(v) for v in r) for r in df.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", SOME)
def test_query_matches_sql(spark, sf, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    assert rows(registry.QUERIES[name](spark, sf).toPandas()) == rows(db.execute(registry.ORACLE_SQL[name]).df())


def test_entry_points(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1
