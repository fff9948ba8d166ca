"""Registered queries of the subpackage against their SQL on the smallest table."""

from __future__ import annotations

import pytest

SF001 = "/root/testdata/sf0.001"


def _keys():
    from archivesearch.llm.queries import ORACLE

    return sorted(ORACLE)


@pytest.mark.parametrize("key", _keys())
def test_query_matches_sql(spark, key):
    import __spark_entry__ as ent
    from archivesearch.plans.compare import compare

    res = compare(spark, key, SF001, ent.queries(), ent.oracle_sql())
    assert res["status"] == "match", res
