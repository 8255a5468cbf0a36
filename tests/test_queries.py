import math
import os

import pytest

import __spark_entry__ as entry
from annospark.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def same(rows):
    return sorted(tuple(repr(round(v, 9)) if isinstance(v, float) and not math.isnan(v) else repr(v) for v in r) for r in rows)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", [f.__name__ for f in QUERIES])
def test_query_equals_sql(spark, name):
    import duckdb

    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows is not None
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert same(rows) == same(tuple(r[names.index(c)] for c in columns) for r in found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "lang", "stratum", "annotation_language"]
