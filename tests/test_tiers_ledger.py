"""Tiers of gold parts and the ledger of source files: O(log k) parts a day, equal to a rebuild,
nothing twice after a lost checkpoint, and crashes at every step are harmless."""

import math
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripflow import schema as S
from tripflow.functions.columns import round_doubles
from tripflow.operators import gold as G
from tripflow.operators import silver as SV
from tripflow.sinks.files import write_table
from tripflow.sources import files as SF
from tripflow.sources.trips import read_trips
from tripflow.streaming import incremental as INC
from tripflow.streaming import ledger as L
from tripflow.streaming import tiers as T
from tripflow.streaming.ingest import run_to_end


def _gold_rows(df):
    return sorted(map(tuple, round_doubles(df.select(*S.GOLD.names), 9).collect()), key=repr)


def _silver_rows(df):
    return sorted(map(tuple, round_doubles(df.select(*S.SILVER.names), 9).collect()), key=repr)


def test_names():
    assert T.parse(T.new_part(12).name) == T.Part(0, 12, 12) and T.parse("t2_5_40") == T.Part(2, 5, 40)
    assert T.parse("t1_5") is None and T.parse("x") is None


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_a_day_keeps_log_many_parts(fan):
    """The pure merge policy over 2,000 batches: each batch in exactly one live part."""
    parts, rewritten = [], 0
    for k in range(2000):
        parts = T.live([*parts, T.new_part(k)])
        assert len(parts) <= (fan - 1) * (math.log(k + 1, fan) + 1) + 1
        assert sorted(b for p in parts for b in range(p.first, p.last + 1)) == list(range(k + 1))
        if merge := T.due(parts, fan):
            new, old = merge
            rewritten += sum(p.last - p.first + 1 for p in old)
            parts = T.live([*parts, new])
            assert not {*old} & {*parts}
    assert rewritten <= 2000 * (math.log(2000, fan) + 1)


def test_dead_parts_are_not_read():
    parts = [T.Part(0, 3, 3), T.Part(0, 4, 4), T.Part(1, 3, 4), T.Part(0, 9, 9), T.Part(2, 0, 4)]
    assert T.live(parts) == [T.Part(2, 0, 4), T.Part(0, 9, 9)]
    # gaps are batches that did not touch the day
    assert T.due([T.Part(0, 1, 1), T.Part(0, 7, 7)], 2) == (T.Part(1, 1, 7), [T.Part(0, 1, 1), T.Part(0, 7, 7)])
    assert T.due([T.Part(1, 1, 7), T.Part(0, 9, 9), T.Part(0, 12, 12)], 2)[0] == T.Part(2, 1, 12)
    assert T.due([T.Part(1, 1, 7), T.Part(0, 9, 9)], 2) is None


def test_many_batches_read_few_parts_and_equal_a_rebuild(spark, tmp_path):
    silver = SV.build_silver(read_trips(spark, SF_SMALL)).filter(F.col("pickup_day") < 4).cache()
    gold_root = str(tmp_path / "gold")
    parts = INC.GoldParts(spark, gold_root, fan=2)
    n, most = 9, 0
    for k in range(n):
        mine = silver.filter(F.pmod(F.xxhash64(S.PICKUP_TS, "total_amount"), F.lit(n)) == k)
        parts.add(G.partial_aggregate(G.gold_input(mine)), k)
        days = [tuple(r) for r in mine.select(*S.PARTITION_COLS).distinct().collect()]
        most = max([most, *parts.rebuild(days).values()])
        if k == 4:
            # a crash after the merge's folders are there, before the old parts go
            kept = INC.delete_folder
            INC.delete_folder = lambda *a: None
            try:
                parts.compact(days)
            finally:
                INC.delete_folder = kept
        else:
            parts.compact(days)
    assert most <= 5  # of 9
    assert _gold_rows(SF.read_table(spark, gold_root)) == _gold_rows(G.build_gold(silver))
    for day in days:
        assert len(parts.of_day(day)) == len(T.live(parts.of_day(day))) <= 4
    silver.unpersist()


def _bronze(spark, tmp_path, files=4):
    t = read_trips(spark, SF_SMALL)
    bronze = str(tmp_path / "bronze")
    write_table(t.repartitionByRange(files, S.PICKUP_TS), bronze, "json", "overwrite")
    return t, bronze


def _run(spark, tmp_path, bronze, checkpoint, **more):
    q = INC.silver_gold_incremental(spark, bronze, str(tmp_path / "silver"), str(tmp_path / "gold"), str(tmp_path / checkpoint), **more)
    run_to_end(q, 300)


def test_a_new_checkpoint_adds_nothing(spark, tmp_path):
    t, bronze = _bronze(spark, tmp_path)
    _run(spark, tmp_path, bronze, "c1", max_files_per_trigger=1)
    once = _silver_rows(SF.read_table(spark, str(tmp_path / "silver")))
    assert once == _silver_rows(SV.build_silver(t))
    _run(spark, tmp_path, bronze, "c2", max_files_per_trigger=3)  # other batches, numbers from 0 again
    assert _silver_rows(SF.read_table(spark, str(tmp_path / "silver"))) == once
    assert _gold_rows(SF.read_table(spark, str(tmp_path / "gold"))) == _gold_rows(G.build_gold(SV.build_silver(t)))
    ledger = L.SourceLedger(spark, INC.ledger_of(str(tmp_path / "silver")), "any")
    files = [r.file for r in ledger.files().collect()]
    assert len(files) == len(set(files)) == len([f for f in os.listdir(bronze) if f.endswith(".json")])
    # and new files come in under the new checkpoint
    write_table(t.limit(50), bronze, "json", "append")
    _run(spark, tmp_path, bronze, "c2")
    assert SF.read_table(spark, str(tmp_path / "silver")).count() > len(once)


@pytest.mark.parametrize("step", ["silver", "parts", "gold", "ledger"])
def test_a_crash_and_a_lost_checkpoint(spark, tmp_path, monkeypatch, step):
    """The second batch dies after a step; then either the same checkpoint goes on or a new one takes over."""
    t, bronze = _bronze(spark, tmp_path, files=3)
    calls = {"n": 0}

    def dies_after(f, at):
        def g(*a, **k):
            out = f(*a, **k)
            calls["n"] += 1
            if calls["n"] == at:
                raise OSError("lost")
            return out

        return g

    with monkeypatch.context() as m:
        if step == "silver":
            m.setattr(INC.GoldParts, "add", lambda *a, fail=dies_after(INC.GoldParts.add, 2): (_ for _ in ()).throw(OSError("lost")) if calls["n"] else fail(*a))
        elif step == "parts":
            m.setattr(INC.GoldParts, "add", dies_after(INC.GoldParts.add, 2))
        elif step == "gold":
            m.setattr(INC.GoldParts, "rebuild", dies_after(INC.GoldParts.rebuild, 2))
        else:
            m.setattr(L.SourceLedger, "finish", dies_after(L.SourceLedger.finish, 2))
        with pytest.raises(RuntimeError):
            _run(spark, tmp_path, bronze, "c1", max_files_per_trigger=1)
    checkpoint = "c1" if step in ("parts", "ledger") else "c2"
    _run(spark, tmp_path, bronze, checkpoint, max_files_per_trigger=2)
    want = SV.build_silver(t)
    assert _silver_rows(SF.read_table(spark, str(tmp_path / "silver"))) == _silver_rows(want)
    assert _gold_rows(SF.read_table(spark, str(tmp_path / "gold"))) == _gold_rows(G.build_gold(want))
    assert not os.listdir(str(tmp_path / "silver_ledger" / "_begun"))


def test_ledger_numbers_and_merges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "FAN", 3)
    path, undone = str(tmp_path / "ledger"), []
    a = L.SourceLedger(spark, path, "a")
    for k in range(7):
        seq = a.begin(k, undone.append)
        assert seq == k
        a.finish(k, seq, [f"f{k}", f"g{k}"])
    assert len(T.parts_in(spark, f"{path}/run=a")) <= 3 and a.files().count() == 14
    assert a.seen(spark.createDataFrame([("f1",)], "file string")) is None  # no other run
    assert a.begin(7, undone.append) == 7  # begun, never finished
    assert L.SourceLedger(spark, path, "a").begin(7, undone.append) == 7 and not undone  # the same batch again
    assert L.SourceLedger(spark, path, "a").begin(6, undone.append) == 6 and undone == [7]  # finished, run again; 7 will not be
    b = L.SourceLedger(spark, path, "b")
    assert b.begin(0, undone.append) == 7
    assert b.begin(1, undone.append) == 8
    # A batch that died between its record and the end of its mark is finished.
    b.finish(1, 8, ["z"])
    os.makedirs(f"{path}/_begun/b~1~8")
    assert L.SourceLedger(spark, path, "c").begin(0, undone.append) == 9 and undone == [7, 7]
    assert sorted(b.seen(spark.createDataFrame([("f1",), ("g6",), ("h",)], "file string"))) == ["f1", "g6"]
