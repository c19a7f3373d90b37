"""Incremental merges and the commit log on small tables."""

import re

import pytest
from pyspark.sql import functions as F

from shelfscope import SELLER_CATALOG
from shelfscope import operators as ops
from shelfscope import plans, sinks, sources

KEYS = ["seller_id", "item_id"]
SCHEMA = "seller_id string, item_id string, marketplace_price double, stock_qty int"


def _rows(df):
    return sorted(tuple(row) for row in df.collect())


def _table(spark, ids, price):
    return spark.createDataFrame([(f"S{i}", f"I{i}", price, i) for i in ids], SCHEMA)


def test_hundred_rows_plus_sixty_make_hundred_and_fifty(spark):
    base = _table(spark, range(100), 10.0)
    incoming = _table(spark, [*range(10), *range(100, 150)], 11.0)
    merged = ops.merge(base, incoming, KEYS, "marketplace_price")
    assert merged.count() == 150
    assert merged.filter("marketplace_price = 11.0").count() == 60
    summary = ops.merge_summary(base, incoming, KEYS).first()
    assert tuple(summary) == (50, 10, 150)


def test_replay_and_partitioning_change_nothing(spark):
    base = _table(spark, range(40), 10.0)
    incoming = _table(spark, [*range(30, 60), *range(30, 60)], 9.0).union(_table(spark, [31], 12.0))
    once = ops.merge(base, incoming, KEYS, "marketplace_price")
    again = ops.merge(once, incoming.repartition(5), KEYS, "marketplace_price")
    assert _rows(once) == _rows(again)
    assert once.count() == 60
    assert once.filter("item_id = 'I31'").first()["marketplace_price"] == 12.0


def test_summary_counts_repeated_keys_once(spark):
    base = _table(spark, range(5), 1.0)
    incoming = _table(spark, [3, 3, 7, 7, 8], 2.0)
    assert tuple(ops.merge_summary(base, incoming, KEYS).first()) == (2, 1, 7)
    nothing = _table(spark, [], 2.0)
    assert tuple(ops.merge_summary(base, nothing, KEYS).first()) == (0, 0, 5)
    assert tuple(ops.merge_summary(nothing, base, KEYS).first()) == (5, 0, 5)


def test_merge_adds_new_columns(spark):
    base = _table(spark, range(3), 1.0)
    incoming = _table(spark, [2, 3], 2.0).withColumn("origin", F.lit("web"))
    merged = {row["item_id"]: row["origin"] for row in ops.merge(base, incoming, KEYS, "marketplace_price").collect()}
    assert merged == {"I0": None, "I1": None, "I2": "web", "I3": "web"}


def test_commit_log_reads_any_instant(spark, tmp_path):
    path = f"{tmp_path}/log"
    first, second = _table(spark, range(4), 1.0), _table(spark, [3, 4], 2.0)
    sinks.write_commit(first, path, "20250101000000000")
    for _ in range(2):  # the second time replaces the commit
        sinks.write_commit(second, path, "20250102000000000")
    log = sources.read_commit_log(spark, path, first.schema)
    before = ops.as_of(log, KEYS, "20241231000000000")
    between = ops.as_of(log, KEYS, "20250101235959999")
    after = ops.as_of(log, KEYS, "20250102000000000")
    assert before.count() == 0
    assert _rows(between.drop("commit_time")) == _rows(first)
    assert _rows(after.drop("commit_time")) == _rows(ops.merge(first, second, KEYS, "stock_qty"))
    assert [tuple(r) for r in ops.commit_timeline(log).collect()] == [
        ("20250101000000000", 4),
        ("20250102000000000", 2),
    ]
    assert "PartitionFilters: [isnotnull(commit_time" in between._jdf.queryExecution().toString()


def test_upsert_writes_a_new_version(spark, tmp_path):
    schema = SELLER_CATALOG.typed_schema
    base = spark.createDataFrame([("S1", "I1", "Lamp", "Home", 1.0, 1), ("S1", "I2", "Desk", "Home", 1.0, 1)], schema)
    batch = spark.createDataFrame(
        [("S1", "I2", "Desk", "Office", 2.0, 1), ("S1", "I2", "Desk", "Home", 1.5, 1), ("S2", "I1", "Lamp", "Home", 1.0, 1)],
        schema,
    )
    paths = f"{tmp_path}/v1", f"{tmp_path}/v2"
    sinks.write_snapshot(base, SELLER_CATALOG, paths[0])
    summary = plans.upsert_snapshot(spark, SELLER_CATALOG, paths[0], batch, paths[1])
    assert tuple(summary.first()) == (1, 1, 3)
    assert _rows(sources.read_snapshot(spark, SELLER_CATALOG, paths[1])) == [
        ("S1", "I1", "Lamp", "Home", 1.0, 1),
        ("S1", "I2", "Desk", "Office", 2.0, 1),
        ("S2", "I1", "Lamp", "Home", 1.0, 1),
    ]
    with pytest.raises(ValueError, match="new path"):
        plans.upsert_snapshot(spark, SELLER_CATALOG, paths[0], batch, paths[0] + "/")


def test_upsert_carries_added_columns(spark, tmp_path):
    schema = SELLER_CATALOG.typed_schema
    rows = [("S1", f"I{i}", "Lamp", "007", 1.0, 1) for i in range(3)]
    sinks.write_snapshot(spark.createDataFrame(rows, schema), SELLER_CATALOG, f"{tmp_path}/v1")
    batch = spark.createDataFrame(rows[2:], schema).withColumn("origin", F.lit("web"))
    plans.upsert_snapshot(spark, SELLER_CATALOG, f"{tmp_path}/v1", batch, f"{tmp_path}/v2")
    added = batch.schema.fields[-1:]
    back = sources.read_snapshot(spark, SELLER_CATALOG, f"{tmp_path}/v2", added)
    assert _rows(back) == [(*rows[0], None), (*rows[1], None), (*rows[2], "web")]
    # A third batch that knows nothing of the column.
    late = spark.createDataFrame([("S9", "I9", "Desk", "8", 2.0, 1)], schema)
    plans.upsert_snapshot(spark, SELLER_CATALOG, f"{tmp_path}/v2", late, f"{tmp_path}/v3")
    found = sources.added_columns(spark, SELLER_CATALOG, f"{tmp_path}/v3")
    origins = sources.read_snapshot(spark, SELLER_CATALOG, f"{tmp_path}/v3", found).select("item_id", "origin")
    assert _rows(origins) == [("I0", None), ("I1", None), ("I2", "web"), ("I9", None)]


def _with_nulls(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_null_key_parts_are_equal(spark):
    base = _with_nulls(spark, [(None, "I1", 1.0, 1), ("S1", None, 1.0, 1), (None, None, 1.0, 1), ("S1", "I1", 1.0, 1)])
    batch = _with_nulls(spark, [(None, "I1", 2.0, 1), (None, None, 2.0, 1), ("S2", None, 2.0, 1), (None, "I1", 1.5, 1)])
    once = ops.merge(base, batch, KEYS, "marketplace_price")
    want = [("S1", None, 1.0), (None, None, 2.0), (None, "I1", 2.0), ("S1", "I1", 1.0), ("S2", None, 2.0)]
    assert sorted((tuple(r)[:3] for r in once.collect()), key=repr) == sorted(want, key=repr)
    again = ops.merge(once, batch, KEYS, "marketplace_price")
    assert sorted(again.collect(), key=repr) == sorted(once.collect(), key=repr)
    assert tuple(ops.merge_summary(base, batch, KEYS).first()) == (1, 2, 5)
    assert tuple(ops.merge_summary(once, batch, KEYS).first()) == (0, 3, 5)
    assert "NestedLoop" not in once._jdf.queryExecution().executedPlan().toString()


CATALOG = SELLER_CATALOG.typed_schema


def _catalog(spark, keys, price):
    rows = [(s, i, "Lamp", "Home", price, 1) for s, i in keys]
    return spark.createDataFrame(rows, CATALOG)


def _files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.glob("_bucket=*/*.parquet")}


def _prices(table):
    return sorted(((r.seller_id, r.item_id, r.marketplace_price) for r in table.read().collect()), key=repr)


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    table = plans.BucketedTable(spark, SELLER_CATALOG, str(tmp_path / "t"))
    keys = [(f"S{i % 50}", f"I{i}") for i in range(2000)] + [(None, "I1"), ("S1", None), (None, None)]
    assert table.create(_catalog(spark, keys, 1.0).repartition(4), 64) == 2003
    before = _files(tmp_path / "t")
    # A thousandth of the keys, one of them null, and a new one.
    batch = _catalog(spark, [("S1", "I1"), (None, "I1"), ("S9", "new")], 2.0)
    summary = table.upsert(batch).first()
    assert tuple(summary) == (1, 2, 2004, summary.touched_buckets, 64)
    assert 1 <= summary.touched_buckets <= 3
    after = _files(tmp_path / "t")
    changed = {f.split("/")[0] for f in before.keys() ^ after.keys()} | {f.split("/")[0] for f in before if before[f] != after.get(f)}
    assert len(changed) == summary.touched_buckets
    want = {(s, i): 1.0 for s, i in keys} | {("S1", "I1"): 2.0, (None, "I1"): 2.0, ("S9", "new"): 2.0}
    assert _prices(table) == sorted(((s, i, p) for (s, i), p in want.items()), key=repr)
    assert tuple(table.upsert(batch).first())[:3] == (0, 3, 2004)
    assert _prices(table) == sorted(((s, i, p) for (s, i), p in want.items()), key=repr)
    nothing = table.upsert(batch.limit(0)).first()
    assert tuple(nothing) == (0, 0, 2004, 0, 64)


def test_bucketed_upsert_reads_only_touched_buckets(spark, tmp_path):
    table = plans.BucketedTable(spark, SELLER_CATALOG, str(tmp_path / "t"))
    table.create(_catalog(spark, [(f"S{i}", f"I{k}") for i in range(20) for k in range(20)], 1.0), 16, by=["seller_id"])
    one_seller = _catalog(spark, [("S3", f"I{k}") for k in range(25)], 3.0)
    assert tuple(table.upsert(one_seller).first()) == (5, 20, 405, 1, 16)
    assert table.read().filter("marketplace_price = 3.0").count() == 25


def test_bucketed_upsert_survives_a_dead_run(spark, tmp_path, monkeypatch):
    table = plans.BucketedTable(spark, SELLER_CATALOG, str(tmp_path / "t"))
    table.create(_catalog(spark, [("S1", f"I{i}") for i in range(40)], 1.0), 8)
    batch = _catalog(spark, [("S1", "I3"), ("S2", "I3")], 2.0)
    calls = []

    def die(self):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("the driver is lost before the table's files are replaced")
        original(self)

    original = plans.BucketedTable._finish
    monkeypatch.setattr(plans.BucketedTable, "_finish", die)
    with pytest.raises(RuntimeError):
        table.upsert(batch)
    monkeypatch.setattr(plans.BucketedTable, "_finish", original)
    # The pending change counts already, and a bucket that was deleted in the middle is not missed.
    pending = [p.name for p in (tmp_path / "t" / "_pending").glob("_bucket=*")]
    for file in (tmp_path / "t" / pending[0]).iterdir():
        file.unlink()
    merged = _prices(table)
    assert len(merged) == 41 and ("S1", "I3", 2.0) in merged and ("S2", "I3", 2.0) in merged
    assert tuple(table.upsert(_catalog(spark, [("S5", "I5")], 5.0)).first())[:3] == (1, 0, 42)
    assert len(_prices(table)) == 42 and not (tmp_path / "t" / "_pending").exists()


def test_bucketed_table_takes_new_columns_and_feeds_the_log(spark, tmp_path):
    table = plans.BucketedTable(spark, SELLER_CATALOG, str(tmp_path / "t"))
    log = str(tmp_path / "log")
    table.create(_catalog(spark, [("S1", f"I{i}") for i in range(9)], 1.0), 4)
    table.upsert(_catalog(spark, [("S1", "I0")], 2.0).withColumn("origin", F.lit("web")), log, "20250101000000000")
    table.upsert(_catalog(spark, [("S1", "I1")], 3.0), log, "20250102000000000")
    origins = {r.item_id: r.origin for r in table.read().collect()}
    assert origins == {f"I{i}": "web" if i == 0 else None for i in range(9)}
    commits = ops.commit_timeline(sources.read_commit_log(spark, log, CATALOG)).collect()
    assert [tuple(c) for c in commits] == [("20250101000000000", 1), ("20250102000000000", 1)]
    with pytest.raises(ValueError, match="origin"):
        table.upsert(_catalog(spark, [("S1", "I1")], 3.0).withColumn("origin", F.lit(1)))


def test_commit_log_reads_snapshots_and_later_commits_only(spark, tmp_path):
    schema = _table(spark, [], 1.0).schema
    log = plans.CommitLog(spark, str(tmp_path / "log"), KEYS, schema, every=3)
    assert log.as_of("9").count() == 0
    whole = plans.CommitLog(spark, str(tmp_path / "whole"), KEYS, schema, every=1000)
    for i in range(7):
        rows = _table(spark, [i, i + 1, 20], float(i))
        log.append(rows, f"{i:03d}")
        whole.append(rows, f"{i:03d}")
    assert log.snapshots() == ["002", "005"] and whole.snapshots() == []
    for i in range(7):
        assert _rows(log.as_of(f"{i:03d}")) == _rows(whole.as_of(f"{i:03d}"))
    plan = log.as_of("006")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*\(commit_time#\d+ > 005\)", plan)
    assert any("_snapshots/005" in f for f in log.as_of("006").inputFiles())
    assert [tuple(r) for r in log.timeline().collect()] == [(f"{i:03d}", 3) for i in range(7)]
    # A commit that is written again replaces itself, also in what later snapshots said.
    for each in (log, whole):
        each.append(_table(spark, [20], 99.0), "004")
    assert log.snapshots() == ["002"]
    assert _rows(log.as_of("005")) == _rows(whole.as_of("005")) and _rows(log.as_of("004")) == _rows(whole.as_of("004"))
