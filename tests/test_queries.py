"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from panel_queries.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    from check_queries import connect

    return connect(SF_DIR)


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the given tables")
@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, con, name):
    from check_queries import compare

    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(got) > 0
    if name in ORACLES:
        assert compare(got, con.execute(ORACLES[name]).df()) == ""


def test_every_query_has_sql_over_the_given_tables():
    assert set(QUERIES) == set(ORACLES)
    for sql in ORACLES.values():
        assert re.search(r"\b(events|lineitem)\b", sql)


def test_flagship_runs(spark):
    rows = entry.entry(spark).collect()
    assert {r["series"] for r in rows} == {"click", "error", "purchase", "signup", "view"}


def test_registering_a_name_twice_is_refused():
    from panel_queries.registry import query

    with pytest.raises(ValueError, match="twice"):
        query("key_sample")(lambda spark, sf: None)
