"""Every query against its SQL counterpart on the smallest tables."""

from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
from check import connect, differences
from tidecast.workload import q_learning

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()
# fewer and smaller trees than the registered runs: the checks are the same
SMALL = {"boosting": {"maxIter": 15}, "forest": {"numTrees": 5, "maxDepth": 6}, "random": 1 / 200, "search": 1 / 100}


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


@pytest.fixture(scope="module")
def results(spark, request):
    """Results of the selected queries, a few queries at a time in the one session."""
    wanted = [
        item.callspec.params["name"]
        for item in request.session.items
        if item.module is request.module and hasattr(item, "callspec")
    ]
    queries = entry.queries()
    q_learning.SETTINGS.update(SMALL)
    with ThreadPoolExecutor(max_workers=4) as pool:
        futures = {name: pool.submit(lambda n: queries[n](spark, SF).toPandas(), name) for name in wanted}
        yield futures
        for future in futures.values():
            future.cancel()
    q_learning.SETTINGS.clear()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(results, duck, name):
    got = results[name].result()
    assert differences(got, duck.execute(ORACLES[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(ORACLES)))
def test_query_without_oracle_has_rows(results, name):
    assert len(results[name].result()) > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
