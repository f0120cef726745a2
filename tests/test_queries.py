"""Every query with SQL agrees with DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from ledgerline.plans import queries

SF = os.environ.get("LEDGERLINE_TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(names, found):
    order = sorted(range(len(names)), key=lambda k: names[k])
    cell = lambda v: round(v, 9) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(cell(r[k]) for k in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_agrees(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    want = duck.sql(queries.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", ["scorer_summary", "cross_country_slices", "gt_explode"])
def test_stored_views_give_the_same(spark, tmp_path, name):
    from ledgerline.sources.fixtures import Fixture

    got, want = queries.ON_VIEWS[name](Fixture(spark, SF).stored(str(tmp_path))), queries.QUERIES[name](spark, SF)
    assert got.schema == want.schema
    assert rows(got.columns, got.collect()) == rows(want.columns, want.collect())


def test_flagship(spark):
    from __spark_entry__ import entry

    r = entry(spark).first()
    assert (r.num_entities, r.macro_f0_5, r.num_singletons) == (150, pytest.approx(0.869900748, abs=1e-9), 27)
