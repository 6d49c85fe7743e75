"""The problems' queries on the smallest tables, against SQL where it can express them."""

import os

import pytest

from tamarin.llm import queries as m
from tests.test_queries import DATA, compare

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
COLUMNS = {"p1_found": ["segment_a", "segment_b", "champ"], "p3_found": ["pair_a", "pair_b"], "p5_found": ["c", "lang"], "p6_found": ["id"], "p8_found": ["doc_id", "item_id"], "p9_found": ["doc_id", "subject"]}


@pytest.mark.parametrize("name", sorted(m.ORACLES))
def test_sql(spark, name):
    compare(spark, m.QUERIES[name], m.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(m.QUERIES) - set(m.ORACLES)))
def test_runs_with_distinct_rows(spark, name):
    df = m.QUERIES[name](spark, DATA).persist()
    assert df.count() > 0
    if name in COLUMNS:
        assert df.columns == COLUMNS[name] and df.distinct().count() == df.count()
