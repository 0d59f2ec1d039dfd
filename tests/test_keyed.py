"""Keyed tables, histories, versioned streams and maintained views: results, untouched files, and lost jobs."""

import datetime as dt
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemill.operators import incremental as inc
from tidemill.session import scratch_path
from tidemill.sources import keyed
from tidemill.sources.keyed import KeyedTable, follow, summed_view
from tidemill.streaming import ingest

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k string, day date, value decimal(10,2), v int"


def hours(n):
    return T0 + dt.timedelta(hours=n)


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows):
    return spark.createDataFrame([(k, day(d), None if x is None else f"{x}", v) for k, d, x, v in rows], "k string, day date, value string, v int").select(
        "k", "day", F.col("value").cast("decimal(10,2)").alias("value"), "v"
    )


def files(path):
    """Names and times of all data files, by bucket."""
    found = defaultdict(set)
    for folder, _, names in os.walk(path.removeprefix("file:") + "/data"):
        for name in names:
            if name.endswith(".parquet"):
                full = os.path.join(folder, name)
                found[folder.rsplit("=", 1)[1]].add((full, os.stat(full).st_mtime_ns))
    return found


def content(table):
    return sorted((tuple(r) for r in table.read().collect()), key=repr)


def test_merge_writes_touched_buckets_only(spark):
    table = KeyedTable(spark, scratch_path(spark, "keyed"), ["k"], buckets=8)
    assert table.read() is None
    rows = {f"k{i}": (f"k{i}", i % 5, i, 1) for i in range(100)}
    table.merge(frame(spark, rows.values()))
    assert content(table) == sorted(map(tuple, frame(spark, rows.values()).collect()), key=repr)
    before, state = files(table.path), table.state()
    changed = [("k3", 9, 5.5, 2), ("k3", 1, 1, 1), ("new", 2, None, 1)]
    table.merge(frame(spark, changed), deletes=frame(spark, [("k7", 0, 0, 0), ("absent", 0, 0, 0)]))
    rows |= {"k3": changed[0], "new": changed[2]}
    del rows["k7"]
    assert content(table) == sorted(map(tuple, frame(spark, rows.values()).collect()), key=repr)
    keys = spark.createDataFrame([("k3",), ("new",), ("k7",)], "k string")
    touched = {r[0] for r in keys.select(table.bucket).collect()}
    after = files(table.path)
    assert {int(b) for b in after if after[b] - before[b]} == touched
    assert all(before[b] <= after[b] for b in before)
    assert {b for b, v in table.state().buckets.items() if v != state.buckets.get(b)} == touched
    signs = sorted((r["k"], r["_sign"]) for r in table.changes(state.version).collect())
    assert signs == [("k3", -1), ("k3", 1), ("k7", -1), ("new", 1)]
    same = table.state()
    table.merge(frame(spark, [changed[0]]))
    assert table.changes(same.version).count() == 0 and table.state().buckets == same.buckets


def test_merge_versions_columns_nulls_and_emptied_buckets(spark):
    table = KeyedTable(spark, scratch_path(spark, "keyed"), ["k"], ("v",), buckets=2)
    table.merge(frame(spark, [("a", 0, 1, 5), (None, 0, 2, 1), ("b", 0, 3, 1)]))
    table.merge(frame(spark, [("a", 0, 9, 4), (None, 0, 8, 2), ("b", 0, 7, 1)]).withColumn("note", F.lit("x")))
    got = {r["k"]: (float(r["value"]), r["note"]) for r in table.read().collect()}
    assert got == {"a": (1.0, None), None: (8.0, "x"), "b": (7.0, "x")}
    table.merge(frame(spark, []), deletes=table.read())
    assert table.read().count() == 0 and table.read().columns == ["k", "day", "value", "v", "note"]
    table.merge(frame(spark, [("z", 0, 1, 1)]))
    assert [r["k"] for r in table.read().collect()] == ["z"]


def test_a_lost_job_leaves_the_table_as_it_was(spark, monkeypatch):
    table = KeyedTable(spark, scratch_path(spark, "keyed"), ["k"], buckets=4)
    table.merge(frame(spark, [(f"k{i}", 0, i, 1) for i in range(20)]))
    want, version = content(table), table.state().version

    def lost(*_):
        raise RuntimeError("lost")

    # After the log; after some buckets; after all of them but before the state.
    monkeypatch.setattr(KeyedTable, "_commit", lost)
    with pytest.raises(RuntimeError):
        table.merge(frame(spark, [("k1", 1, 100, 2)]))
    monkeypatch.undo()
    assert content(table) == want and table.changes(version) is None
    table._rows(table.state()).limit(3).write.parquet(f"{table.path}/data/version={table._next()}/key_bucket=1")
    table._rows(table.state()).limit(1).write.parquet(f"{table.path}/state/version={table._next()}/part")  # no mark of success
    assert content(table) == want
    table.merge(frame(spark, [("k1", 1, 100, 2)]))
    assert [float(r["value"]) for r in table.read().where("k = 'k1'").collect()] == [100.0]
    assert table.changes(version).count() == 2


def test_vacuum_keeps_what_readers_need(spark):
    table = KeyedTable(spark, scratch_path(spark, "keyed"), ["k"], buckets=4)
    for n in range(4):
        table.merge(frame(spark, [(f"k{i}", 0, i * n, n) for i in range(n, 10)]))
    want, versions = content(table), table._complete()
    table.vacuum(keep=2)
    assert content(table) == want and table._complete() == versions[:2]
    assert table.changes(versions[1]).count() > 0
    with pytest.raises(ValueError, match="not kept"):
        table.changes(versions[2])
    named = {f"{v}" for v in table.state().buckets.values()} | {f"{v}" for v in table.state(versions[1]).buckets.values()}
    left = {f.split("version=")[1].split("/")[0] for names in files(table.path).values() for f, _ in names}
    assert left <= named


def test_history_rewrites_changed_buckets_only(spark):
    table = KeyedTable(spark, scratch_path(spark, "history"), ["k"], buckets=16)
    random.seed(4)
    state = {f"k{i}": (i, hours(0)) for i in range(60)}
    plain = None
    for step in range(1, 5):
        before, known = files(table.path), table.state()
        changed = set()
        for k in random.sample(sorted(state), 3):
            state[k] = (state[k][0] + 1, hours(step))
            changed.add(k)
        gone = random.choice(sorted(state))
        del state[gone]
        state[f"new{step}"] = (0, hours(step))
        changed |= {gone, f"new{step}"}
        source = spark.createDataFrame([(k, x, t) for k, (x, t) in state.items()], "k string, x int, updated timestamp")
        inc.scd2_apply(table, source, "updated", F.lit(hours(step)))
        plain = inc.scd2_snapshot(plain, source, ["k"], "updated", F.lit(hours(step)))
        columns = ["k", "x", "updated", "valid_from", "valid_to", "is_current"]
        assert sorted(map(tuple, table.read().select(columns).collect()), key=repr) == sorted(map(tuple, plain.select(columns).collect()), key=repr)
        if known.version:
            touched = {r[0] for r in spark.createDataFrame([(k,) for k in changed], "k string").select(table.bucket).collect()}
            assert {b for b, v in table.state().buckets.items() if v != known.buckets.get(b)} <= touched
            assert all(before[b] <= files(table.path)[b] for b in before)
    version = table.state().version
    inc.scd2_apply(table, source, "updated", F.lit(hours(9)))
    assert table.state().version == version


# --- maintained views -----------------------------------------------------------------------


def plain_totals(rows):
    out = defaultdict(lambda: [None, 0])
    for _, d, x, _ in rows:
        total = out[day(d)]
        total[1] += 1
        if x is not None:
            total[0] = (total[0] or 0) + x
    return sorted(((d, t, n) for d, (t, n) in out.items()), key=repr)


def view_rows(view):
    return sorted(((r["day"], None if r["total"] is None else float(r["total"]), r["row_count"]) for r in view.read().collect()), key=repr)


def test_view_follows_random_changes(spark, monkeypatch):
    random.seed(7)
    source = KeyedTable(spark, scratch_path(spark, "orders"), ["k"], buckets=8)
    view = summed_view(spark, scratch_path(spark, "view"), "day", F.unix_date("day"))
    assert follow(source, view, {"total": "value"}).version == 0
    rows = {f"k{i}": (f"k{i}", i % 12, i / 2, 0) for i in range(60)}
    source.merge(frame(spark, rows.values()))
    follow(source, view, {"total": "value"})
    assert view_rows(view) == plain_totals(rows.values())
    for step in range(1, 4):
        gone = random.sample(sorted(rows), 3)
        moved = {k: (k, random.randrange(14), random.choice([None, 1.5, 20.0]), step) for k in random.sample([k for k in rows if k not in gone], 3)}
        moved[f"new{step}"] = (f"new{step}", 12 + step, 4.0, step)
        deleted = [rows[k] for k in gone]
        days = {day(rows[k][1]) for k in [*gone, *moved] if k in rows} | {day(r[1]) for r in moved.values()}
        rows |= moved
        for k in gone:
            del rows[k]
        source.merge(frame(spark, moved.values()), deletes=frame(spark, deleted))
        if step == 2:  # two changes of the source are followed in one step
            continue
        known = view.state()
        reads = []
        read = KeyedTable.read
        monkeypatch.setattr(KeyedTable, "read", lambda self, only=None: (reads.append((self.path, only)), read(self, only))[1])
        follow(source, view, {"total": "value"})
        monkeypatch.undo()
        assert view_rows(view) == plain_totals(rows.values())
        assert all(path != source.path and only is not None for path, only in reads)  # neither table is read as a whole
        if step == 1:
            changed = {b for b in {**known.buckets, **view.state().buckets} if known.buckets.get(b) != view.state().buckets.get(b)}
            assert changed <= {(d - dt.date(1970, 1, 1)).days for d in days}
    version = view.state().version
    follow(source, view, {"total": "value"})  # a repeated run
    assert view.state().version == version


def test_view_after_a_lost_run_and_a_vacuum(spark, monkeypatch):
    source = KeyedTable(spark, scratch_path(spark, "orders"), ["k"], buckets=4)
    view = summed_view(spark, scratch_path(spark, "view"), "day")
    rows = {f"k{i}": (f"k{i}", i % 3, float(i), 0) for i in range(12)}
    source.merge(frame(spark, rows.values()))
    follow(source, view, {"total": "value"})
    rows["k1"] = ("k1", 2, 50.0, 1)
    source.merge(frame(spark, [rows["k1"]]))

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(KeyedTable, "_commit", lost)
    with pytest.raises(RuntimeError):
        follow(source, view, {"total": "value"})
    monkeypatch.undo()
    follow(source, view, {"total": "value"})
    assert view_rows(view) == plain_totals(rows.values())
    for n in range(3):
        rows["k2"] = ("k2", 9 + n, 1.0, 2 + n)
        source.merge(frame(spark, [rows["k2"]]))
    source.vacuum(keep=1)
    follow(source, view, {"total": "value"})  # the log does not reach back: made anew
    assert view_rows(view) == plain_totals(rows.values())


# --- versioned streams ----------------------------------------------------------------------


def test_merged_batches_are_read_once(spark, monkeypatch):
    path = scratch_path(spark, "versions")
    make = lambda rows: spark.createDataFrame(rows, "k string, v int, n int")
    for batch, rows in enumerate([[("a", 1, 1), ("b", 1, 1)], [("a", 3, 3), ("c", 1, 9)], [("a", 2, 2)]]):
        make(rows).write.parquet(f"{path}/batch={batch}")
    newest = lambda: sorted(tuple(r) for r in ingest.read_versioned(spark, path, ["k"], "v").collect())
    want = [("a", 3, 3), ("b", 1, 1), ("c", 1, 9)]
    assert newest() == want

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # before the new state is written
        m.setattr(KeyedTable, "_commit", lost)
        with pytest.raises(RuntimeError):
            ingest.merge_batches(spark, path, ["k"], "v")
    assert newest() == want
    with monkeypatch.context() as m:  # after it, before the merged batches are dropped
        m.setattr(ingest, "delete", lost)
        with pytest.raises(RuntimeError):
            ingest.merge_batches(spark, path, ["k"], "v")
    assert newest() == want
    assert not any("batch=" in f for f in ingest.read_versioned(spark, path, ["k"], "v").inputFiles())
    assert ingest.merge_batches(spark, path, ["k"], "v") == 2
    assert not [n for n in os.listdir(path.removeprefix("file:")) if n.startswith("batch=")]

    make([("a", 9, 9)]).write.parquet(f"{path}/batch=3")
    assert newest()[0] == ("a", 9, 9)
    make([("a", 99, 99)]).write.parquet(f"{path}/batch=1")  # a replay of what is merged
    assert newest()[0] == ("a", 9, 9)
    state = keyed.KeyedTable(spark, f"{path}/_base", ["k"]).state()
    assert ingest.merge_batches(spark, path, ["k"], "v") == 3 and newest()[0] == ("a", 9, 9)
    assert state.through == 2


def test_stream_skips_merged_batches(spark):
    path, inbox, progress = (scratch_path(spark, n) for n in ("versions", "inbox", "progress"))
    spark.createDataFrame([("a", 1)], "k string, v int").write.parquet(inbox)
    stream = lambda: spark.readStream.schema("k string, v int").parquet(inbox)
    ingest.upsert_stream(stream(), path, progress).awaitTermination()
    assert ingest.merge_batches(spark, path, ["k"], "v") == 0
    ingest.upsert_stream(stream(), path, scratch_path(spark, "progress")).awaitTermination()  # its marks are lost: batch 0 again
    assert not [n for n in os.listdir(path.removeprefix("file:")) if n.startswith("batch=")]
    assert [tuple(r) for r in ingest.read_versioned(spark, path, ["k"], "v").collect()] == [("a", 1)]


def test_rows_that_arrive_during_a_load_are_left_to_the_next(spark):
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "loaded")
    arrive = lambda *moments: spark.createDataFrame([(m,) for m in moments], "ingested_at timestamp").write.mode("append").parquet(inbox)
    arrive(hours(1), hours(2))
    store = inc.CheckpointStore(spark, scratch_path(spark, "marks"))

    def fetch(start):
        return spark.read.parquet(inbox).where(F.col("ingested_at") >= inc.at(start))

    def write(batch):
        arrive(hours(9))
        batch.write.mode("append").parquet(out)

    first = inc.incremental_load(store, "s", "t", fetch, write, now=hours(10))
    assert first["records_processed"] == 2 == spark.read.parquet(out).count()
    assert store.get("s", "t") == hours(2)
    second = inc.incremental_load(store, "s", "t", fetch, lambda b: b.write.mode("append").parquet(out), lookback_hours=0, now=hours(20))
    assert second["checkpoint_value"] == hours(9)
