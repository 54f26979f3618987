"""The warehouse queries under a checkpoint directory given as a URI (``file:///...``), as clusters name theirs."""

from datetime import datetime, timedelta

import pytest

from tripflow import schema as S
from tripflow import session
from tripflow.operators import gold as G
from tripflow.plans import catalog


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    start = datetime(2024, 1, 9, 5, 0, 0)
    events = [(i, start + timedelta(hours=3 * i), 7 * i % 11, "click", 1.5 + i % 40, f'{{"k": {i % 60}}}') for i in range(1, 41)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(events, schema).write.parquet(f"{root}/events.parquet")
    return root


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("name", ["load_summary", "warehouse_append", "warehouse_balanced", "warehouse_refresh_days", "warehouse_roundtrip", "warehouse_truncate_reload"])
def test_warehouse_queries_with_a_checkpoint_uri(spark, sf, tmp_path, monkeypatch, name):
    monkeypatch.setattr(session, "checkpoint_root", lambda s: f"file://{tmp_path}/shared")
    found = _rows(catalog.queries()[name](spark, sf))
    gold = catalog._r(catalog.gold(spark, sf).select(*S.GOLD.names))
    if name == "load_summary":
        gold = gold.groupBy(*S.PARTITION_COLS).count().withColumnRenamed("count", "n_rows")
    elif name == "warehouse_refresh_days":
        gold = catalog._r(G.build_gold(catalog._corrected(catalog.silver(spark, sf))).select(*S.GOLD.names))
    assert found and found == _rows(gold)


@pytest.mark.parametrize("root", ["/tmp/a b#c%20d", "file:/tmp/a b#c%20d", "file:///tmp/a b#c%20d"])
def test_derby_gets_a_local_path(spark, monkeypatch, root):
    monkeypatch.setattr(session, "checkpoint_root", lambda s: root)
    url, _ = catalog._derby_url(spark)
    assert url.startswith("jdbc:derby:/tmp/a b#c%20d/warehouse-") and url.endswith("/db;create=true")
