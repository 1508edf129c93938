import pytest

import __spark_entry__ as entry
from check import compare, duck
from rowtide.plans.checks import CHECKS
from rowtide.plans.queries import QUERIES
from rowtide.plans import log_queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(CHECKS)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["seq", "id", "name", "create_time", "modify_time"]
    assert df.count() == 8


def test_versions_are_decoded_once(spark, sf_dir, monkeypatch):
    read = []
    monkeypatch.setattr(log_queries, "update_versions", lambda spark, spec, batch: read.append(batch.inputFiles()))
    monkeypatch.setattr(log_queries, "stored_versions", lambda spark, spec: None)
    log_queries.versions_kept_up(spark, sf_dir)
    assert len(read) == 3 and all("/dims/" in f for files in read for f in files)
