"""Every registered query against its SQL twin, bit for bit, at the smallest scale."""

from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as contract
from parity.compare import connect, differences
from parity.oracle import ORACLE
from parity.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def found(spark):
    """All comparisons, several at a time: at this scale the wait is for planning."""
    con = connect(SF)

    def compare(name):
        try:
            return differences(spark, con.cursor(), name, SF)[0]
        except Exception as error:  # noqa: BLE001 - belongs to that query's test
            return [repr(error)]

    with ThreadPoolExecutor(6) as pool:
        return dict(zip(QUERIES, pool.map(compare, QUERIES)))


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLE.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(found, name):
    assert not found[name]


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["assign_files", "facility_summary", "census_histogram", "describe_stats",
                                  "join_provider_salted", "kpi_cards"])
def test_no_product_of_tables(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_scan_reads_only_what_is_asked(spark):
    plan = QUERIES["tier_distribution"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    lineitem = next(line for line in plan.splitlines() if "lineitem" in line)
    assert "l_extendedprice" not in lineitem and "l_comment" not in lineitem and "l_tax" not in lineitem
