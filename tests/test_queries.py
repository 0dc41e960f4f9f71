"""Every registered query against its comparison SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from bindings.queries import QUERIES
from orderloom.plans import quality
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_every_query_has_comparison_sql():
    assert set(QUERIES) - set(entry.oracle_sql()) == set()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, small, duck, name):
    result = entry.queries()[name](spark, small)
    assert differences(result, entry.oracle_sql()[name], duck) == []


@pytest.mark.parametrize("name", ["cycle_dominant_app", "fct_order_cycles", "cycle_bursts"])
def test_cycle_query_matches_sql_with_many_groups(spark, name):
    folder = "/root/testdata/sf0.01"
    result = entry.queries()[name](spark, folder)
    assert differences(result, entry.oracle_sql()[name], connect(folder)) == []


def test_the_summary_of_all_checks_runs_every_declared_check(spark, small):
    declared = {f"unique_{m}_{c}" for m, columns in quality.UNIQUE.items() for c in columns}
    declared |= {f"not_null_{m}_{c}" for m, columns in quality.NOT_NULL.items() for c in columns}
    declared |= {f"unique_combination_{m}" for m in quality.COMBINATION}
    declared |= {f"accepted_values_{m}_{c}" for m, c in quality.ACCEPTED}
    declared |= {f"relationships_{m}_{c}" for m, c in quality.RELATIONSHIPS}
    declared.add("sales_code_present")
    ran = [r.check_name for r in entry.queries()["check_summary_all"](spark, small).collect()]
    assert len(ran) == len(set(ran))
    assert {n for n in ran if "_wms_" not in n} == declared
    base = {r.check_name for r in entry.queries()["check_summary"](spark, small).collect()}
    assert {n for n in base if "_wms_" in n} == {n for n in ran if "_wms_" in n} != set()
