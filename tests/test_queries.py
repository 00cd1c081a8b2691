"""Every query of the library against its SQL."""

import pytest

from streamlog.plans import log_queries, stream_queries  # noqa: F401
from streamlog.plans.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(name, same):
    same(QUERIES[name], ORACLES[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 3
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(QUERIES) <= set(e.queries())


def test_micro_batches_cover_the_log(spark, data):
    rows = QUERIES["micro_batches"](spark, data).toPandas()
    total = spark.read.parquet(f"{data}/events.parquet").count()
    assert rows.n.sum() == total
    assert (rows.groupby("batch_no").n.sum().iloc[:-1] == 1000).all()
    for _, g in rows.sort_values("batch_no").groupby("stream"):
        assert g.lo.iloc[0] == 0 and (g.lo.iloc[1:].to_numpy() == g.hi.iloc[:-1].to_numpy() + 1).all()
