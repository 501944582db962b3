"""Registered queries against their SQL, over the whole smallest tables;
`python -m verification.compare <dir>` does so for any scale."""

import pytest

from verification import queries
from verification.compare import differences
from verification.queries import QUERIES, SQL

@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sql_tables, sf_dir, name):
    assert differences(spark, sql_tables, sf_dir, name) is None


@pytest.mark.parametrize("name", ["base_apple", "alerts_label_spotify", "trending_regions_spotify"])
def test_same_results_when_every_join_shuffles_and_splits(
    spark, sql_tables, sf_dir, settings, monkeypatch, name
):
    monkeypatch.setattr(queries, "WRITTEN", {})
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
    )
    assert differences(spark, sql_tables, sf_dir, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert "rank_adj_score" in __spark_entry__.entry(spark).columns
