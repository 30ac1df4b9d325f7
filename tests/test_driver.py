"""What goes through the driver: settings and pools, never a table of members, however small its files are."""

import pytest

from arborpay.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def broadcast_rows(spark, act):
    """Rows of every broadcast that act() sends through the driver."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    act()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    last = store.executionsList().last().executionId()
    rows = []
    for k in range(last - (store.executionsCount() - before) + 1, last + 1):
        values, nodes = store.executionMetrics(k), store.planGraph(k).allNodes()
        for node in (nodes.apply(i) for i in range(nodes.size())):
            if node.name() == "BroadcastExchange":
                of = [node.metrics().apply(i) for i in range(node.metrics().size())]
                found = [values.get(m.accumulatorId()) for m in of if m.name() == "number of output rows"]
                rows += [int(v.get().replace(",", "")) for v in found if v.isDefined()]
    return rows


@pytest.mark.parametrize("name", ["ragged_ranks", "team_bonus", "leadership_bonus"])
def test_no_table_of_members_is_broadcast(spark, name):
    n = spark.read.parquet(f"{SMALL}/customer.parquet").count()
    rows = broadcast_rows(spark, lambda: QUERIES[name](spark, SMALL).collect())
    assert max(rows, default=0) <= 30 < n / 3, sorted(rows)[-5:]
