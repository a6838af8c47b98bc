"""Every query of the catalogue against its SQL, and the promises that hold for all of them."""

from pathlib import Path

import pytest

from adjudica.catalogue import ORACLE, QUERIES
from __spark_entry__ import entry, oracle_sql, queries
from tools.check import database, rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def db():
    return database(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, db, name):
    df = queries()[name](spark, SF)
    wanted = db.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(wanted.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(wanted.columns, wanted.fetchall())


def test_every_query_of_the_catalogue_has_sql():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "version_number" in df.columns


@pytest.mark.parametrize(
    "name", ["version_numbering", "carry_forward", "source_overlap", "activity_product_scores", "yearly_amounts", "consolidate_union"]
)
def test_result_does_not_depend_on_the_number_of_partitions(spark, name):
    results = []
    for partitions in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        df = queries()[name](spark, SF)
        results.append(rows(df.columns, [tuple(r) for r in df.collect()]))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


@pytest.mark.parametrize("name", ["version_numbering", "carry_forward", "clean_text", "holders_explode", "source_overlap", "cache_upsert"])
def test_plans_stay_in_the_jvm_and_form_no_cross_products(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "NestedLoop", "Python", "BatchEval"):
        assert unwanted not in plan
