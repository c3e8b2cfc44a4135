"""Every registered query of the library proper against its SQL, on the smallest tables."""

from __future__ import annotations

import numbers

import duckdb
import numpy as np
import pandas as pd
import pytest
from conftest import DATA

from medleaf import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FOLDER = f"{DATA}/sf0.001"


def normal(df: pd.DataFrame) -> list[tuple]:
    def text(v):
        if v is None or (not isinstance(v, list) and pd.isna(v)):
            return ""
        if isinstance(v, numbers.Number) and not isinstance(v, (bool, np.bool_)):
            return repr(round(float(v), 9))  # whole numbers with nulls are floats in pandas
        return str(v)

    return sorted(tuple(text(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    ours, theirs = plans.queries()[name](spark, FOLDER).toPandas(), duck.sql(plans.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert normal(ours) == normal(theirs)


def test_every_query_has_sql():
    assert set(plans.queries()) == set(plans.oracle_sql())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
