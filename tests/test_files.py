"""Landing files: scans, pre-flight checks and streaming ingestion."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfscope import COMPANY_SALES, COMPETITOR_SALES, SELLER_CATALOG
from shelfscope import operators as ops
from shelfscope import plans, sources, streaming
from shelfscope.plans import seen
from shelfscope.sinks import reports
from shelfscope.sources import files

HEADER = "item_id,units_sold,revenue,sale_date"


def _put(folder: Path, name: str, lines: list[str]) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    file = folder / name
    file.write_text("".join(line + "\n" for line in lines))
    return file


def _by_name(df):
    return {Path(row["path"]).name: row for row in df.collect()}


def test_scan_reads_strings_and_pads_short_rows(spark, tmp_path):
    _put(tmp_path, "a.csv", [HEADER, ' I1 , 2,"  ",', "I2", "I3,1,2,2025-01-01,extra", '"",,,'])
    _put(tmp_path, "skipped.txt", [HEADER, "I9,1,1,1"])
    rows = {row["item_id"]: tuple(row)[1:] for row in sources.scan_csv(spark, COMPANY_SALES, str(tmp_path)).collect()}
    assert rows == {
        "I1": ("2", "  ", None),
        "I2": (None, None, None),
        "I3": ("1", "2", "2025-01-01"),
        None: (None, None, None),
    }
    one = sources.scan_csv(spark, COMPANY_SALES, str(tmp_path / "a.csv"))
    assert one.count() == 4


def test_inventory_lists_empty_files_and_odd_names(spark, tmp_path):
    folder = tmp_path / "some folder"
    _put(folder, "a+b c%20.csv", [HEADER])
    _put(folder, "empty.csv", [])
    found = _by_name(sources.file_inventory(spark, str(folder)))
    assert found["empty.csv"]["is_empty"]
    assert found["empty.csv"]["size_bytes"] == 0
    assert found["a+b c%20.csv"]["size_bytes"] == len(HEADER) + 1


@pytest.mark.parametrize(
    ("files", "path", "usable"),
    [
        ({}, "nowhere", False),
        ({"note.txt": ["x"]}, "", False),
        ({"empty.csv": []}, "", True),
        ({"empty.csv": []}, "empty.csv", False),
        ({"full.csv": ["x"]}, "full.csv", True),
    ],
)
def test_presence(spark, tmp_path, files, path, usable):
    for name, lines in files.items():
        _put(tmp_path, name, lines)
    inventory = sources.file_inventory(spark, str(tmp_path / path))
    assert sources.has_input(inventory, single_file=path.endswith(".csv")) is usable


def test_header_and_row_count_per_file(spark, tmp_path):
    body = [f"I{i},1,1.0,2025-01-01" for i in range(10)]
    _put(tmp_path, "good.csv", [HEADER, *body])
    _put(tmp_path, "quoted.csv", [",".join(f'"{c}"' for c in HEADER.split(",")), *body])
    _put(tmp_path, "later.csv", ["units_sold,item_id,revenue,sale_date", HEADER, *body])
    _put(tmp_path, "short.csv", [HEADER, *body[:9]])
    _put(tmp_path, "empty.csv", [])
    headers = _by_name(sources.header_contract(spark, COMPANY_SALES, str(tmp_path)))
    assert {name: row["header_ok"] for name, row in headers.items()} == {
        "good.csv": True,
        "quoted.csv": True,
        "later.csv": False,
        "short.csv": True,
        "empty.csv": False,
    }
    counts = _by_name(sources.min_row_count(spark, COMPANY_SALES, str(tmp_path)))
    assert {name: (row["n_rows"], row["enough_rows"]) for name, row in counts.items()} == {
        "good.csv": (10, True),
        "quoted.csv": (10, True),
        "later.csv": (11, True),
        "short.csv": (9, False),
        "empty.csv": (-1, False),
    }


def test_header_of_a_file_with_many_splits(spark, tmp_path):
    _put(tmp_path, "big.csv", [HEADER, *(f"I{i},1,1.0,2025-01-01" for i in range(20000))])
    _put(tmp_path, "bad.csv", ["wrong", *(HEADER for _ in range(20000))])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        profile = _by_name(sources.line_profile(spark, COMPANY_SALES, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert (profile["big.csv"]["n_rows"], profile["big.csv"]["header_ok"]) == (20000, True)
    assert (profile["bad.csv"]["n_rows"], profile["bad.csv"]["header_ok"]) == (20000, False)


def test_verdicts(spark, tmp_path):
    body = [f"I{i},1,1.0,2025-01-01" for i in range(10)]
    _put(tmp_path / "company_sales", "a.csv", [HEADER, *body])
    _put(tmp_path / "competitor_sales", "a.csv", [HEADER, *body[:2]])
    _put(tmp_path / "competitor_sales", "b.csv", [COMPETITOR_SALES.header_line, *body[:2]])
    inputs = {
        spec: str(tmp_path / spec.name) for spec in (COMPANY_SALES, COMPETITOR_SALES, SELLER_CATALOG)
    }
    got = {tuple(row) for row in sources.dataset_verdicts(spark, inputs).collect()}
    assert got == {
        ("company_sales", 1, 0, 0, True),
        ("competitor_sales", 2, 1, 1, False),
        ("seller_catalog", 0, 0, 0, False),
    }


def test_landing_takes_each_file_once(spark, tmp_path):
    folders = {n: str(tmp_path / n) for n in ("source", "bronze", "checkpoint", "archive")}

    def ingest():
        return streaming.ingest_landing(spark, COMPANY_SALES, max_files_per_batch=1, **folders)

    def landed():
        rows = streaming.read_bronze(spark, COMPANY_SALES, folders["bronze"]).collect()
        return sorted(row["item_id"] for row in rows)

    assert ingest() is False
    _put(tmp_path / "source", "one.csv", [HEADER, "I1,1,1.0,2025-01-01"])
    _put(tmp_path / "source", "two.csv", [HEADER, "I2,1,1.0,2025-01-01"])
    assert ingest() is True
    assert landed() == ["I1", "I2"]
    assert ingest() is True
    assert landed() == ["I1", "I2"]
    _put(tmp_path / "source", "three.csv", [HEADER, "I3,1,1.0,2025-01-01"])
    ingest()
    assert landed() == ["I1", "I2", "I3"]
    assert list((tmp_path / "archive").rglob("one.csv"))


def test_reports_keep_blanks_and_line_breaks(spark, tmp_path):
    row = ("\tS1 ", "I\n2", 'a "b", c', " x", 1.5, 2.0, 3.0)
    report = spark.createDataFrame([row], reports.RECOMMENDATION_SCHEMA)
    reports.write_recommendations(report, str(tmp_path / "report"))
    assert [tuple(r) for r in reports.read_recommendations(spark, str(tmp_path / "report")).collect()] == [row]
    gap = spark.createDataFrame([("I1", " n\n", "c", 5, 1.0, 2.0)], reports.GAP_SCHEMA)
    assert reports.write_company_gap(gap, str(tmp_path / "gap"))
    assert not reports.write_company_gap(gap.limit(0), str(tmp_path / "none"))
    assert [r.item_name for r in reports.read_gap(spark, str(tmp_path / "gap")).collect()] == [" n\n"]


def test_landing_reads_old_files_and_refuses_used_names(spark, tmp_path):
    places = [str(tmp_path / name) for name in ("landing", "bronze", "checkpoint")]
    landing, archive = tmp_path / "landing", str(tmp_path / "archive")

    def run():
        return streaming.ingest_landing(spark, COMPANY_SALES, *places, archive=archive)

    def landed():
        return sorted(r.item_id for r in streaming.read_bronze(spark, COMPANY_SALES, places[1]).collect())

    _put(landing, "a.csv", [HEADER, "I1,1,1.0,2025-01-01"])
    run()
    late = _put(landing, "late.csv", [HEADER, "I2,1,1.0,2025-01-01"])
    os.utime(late, (late.stat().st_mtime - 30 * 86400,) * 2)
    run()
    assert landed() == ["I1", "I2"]
    again = _put(landing, "late.csv", [HEADER, "I3,1,1.0,2025-01-01"])
    with pytest.raises(ValueError, match="used name"):
        run()
    assert again.exists() and landed() == ["I1", "I2"]
    again.rename(landing / "new.csv")
    run()
    run()
    assert landed() == ["I1", "I2", "I3"]


def test_landing_that_dies_between_rows_and_ledger_loses_nothing(spark, tmp_path, monkeypatch):
    places = [str(tmp_path / name) for name in ("landing", "bronze", "checkpoint")]
    source, archive = tmp_path / "landing", str(tmp_path / "archive")

    def run():
        return streaming.ingest_landing(spark, COMPANY_SALES, *places, archive=archive)

    def landed():
        return sorted(r.item_id for r in streaming.read_bronze(spark, COMPANY_SALES, places[1]).collect())

    _put(source, "a.csv", [HEADER, "I1,1,1.0,2025-01-01"])
    run()
    late = _put(source, "b.csv", [HEADER, "I2,1,1.0,2025-01-01", "I3,1,1.0,2025-01-01"])

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(streaming.landing, "_note_batch", die)
        with pytest.raises(Exception, match="lost"):
            run()
    assert landed() == ["I1", "I2", "I3"] and late.exists()
    # Delivered again under the name of the file whose batch is not settled: refused, nothing moved.
    kept = late.read_text()
    _put(source, "b.csv", [HEADER, "I9,1,1.0,2025-01-01"])
    with pytest.raises(ValueError, match="used name"):
        run()
    assert landed() == ["I1", "I2", "I3"]
    # Under a name of its own it lands; the batch that was written is kept, though its file has gone.
    late.rename(source / "c.csv")
    run()
    run()
    assert landed() == ["I1", "I2", "I3", "I9"]
    assert "I2" in kept
    assert streaming.landed_batches(spark, places[2]) == ["0000000000", "0000000001", "0000000002"]


def test_landing_marks_rows_of_files_with_another_header(spark, tmp_path):
    places = [str(tmp_path / name) for name in ("landing", "bronze", "checkpoint")]
    _put(tmp_path / "landing", "good [1] 100%25.csv", [HEADER, "I1,1,1.0,2025-01-01"])
    _put(tmp_path / "landing", "bad.csv", ["units_sold,item_id,revenue,sale_date", "1,I2,1.0,2025-01-01"])
    streaming.ingest_landing(spark, COMPANY_SALES, *places)
    rows = streaming.read_landed(spark, COMPANY_SALES, places[1], places[2])
    assert sorted((r.item_id, r.header_mismatch) for r in rows.collect()) == [("1", True), ("I1", False)]
    none = streaming.read_landed(spark, COMPANY_SALES, places[1], places[2], ["0000000007"])
    assert none.count() == 0


def test_landing_refuses_a_foreign_checkpoint(spark, tmp_path):
    _put(tmp_path / "landing", "a.csv", [HEADER, "I1,1,1.0,2025-01-01"])
    places = [str(tmp_path / name) for name in ("landing", "bronze")]
    streaming.ingest_landing(spark, COMPANY_SALES, *places, str(tmp_path / "one"))
    with pytest.raises(ValueError, match="another checkpoint"):
        streaming.ingest_landing(spark, COMPANY_SALES, *places, str(tmp_path / "two"))


def test_etl_loads_the_good_file_only(spark, tmp_path):
    body = [f"I{i},1,1.0,2025-01-0{i}" for i in range(1, 4)]
    _put(tmp_path / "in", "good.csv", [HEADER, *body, "I9,-1,1.0,2025-01-01"])
    _put(tmp_path / "in", "swapped.csv", ["revenue,units_sold,item_id,sale_date", "1.0,1,I7,2025-01-01"])
    run = plans.run_etl_from_csv(spark, COMPANY_SALES, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "q"))
    assert sorted(r.item_id for r in run.table.collect()) == ["I1", "I2", "I3"]
    reasons = sorted(r.dq_failure_reason for r in spark.read.parquet(str(tmp_path / "q")).collect())
    assert reasons == ["header_mismatch;", "units_sold_negative;"]
    counts = run.metrics.select("records.*").first()
    assert (counts.input_count, counts.valid_count, counts.invalid_count) == (5, 3, 2)


def test_landing_run_is_repeatable(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    _put(tmp_path / "landing", "a.csv", [HEADER, "I1,1,1.0,2025-01-01", "I2,1,1.0,2025-01-01", "I3,x,1.0,bad"])

    def run():
        return plans.run_landing(spark, COMPANY_SALES, root, buckets=4)

    def table():
        read = plans.BucketedTable(spark, COMPANY_SALES, f"{root}/table").read()
        return sorted((r.item_id, r.units_sold) for r in read.collect())

    # The first run dies after the upsert, before its batch counts as taken in.
    def die(self, *args):
        original(self, *args)
        raise RuntimeError("lost")

    original = plans.BucketedTable.upsert
    with monkeypatch.context() as broken:
        broken.setattr(plans.BucketedTable, "upsert", die)
        with pytest.raises(RuntimeError, match="lost"):
            run()
    first = run()
    assert (first.batches, tuple(first.summary.first())[:3]) == (["0000000000"], (0, 2, 2))
    _put(tmp_path / "landing", "b.csv", [HEADER, "I2,7,1.0,2025-02-01", "I4,1,1.0,2025-01-01"])
    second = run()
    assert tuple(second.summary.first())[:3] == (1, 1, 3)
    assert table() == [("I1", 1), ("I2", 7), ("I4", 1)]
    nothing = run()
    assert nothing.batches == [] and tuple(nothing.summary.first())[:3] == (0, 0, 3)
    log = sources.read_commit_log(spark, f"{root}/commits", COMPANY_SALES.typed_schema)
    before = ops.as_of(log, ["item_id"], "0000000000")
    assert sorted((r.item_id, r.units_sold) for r in before.collect()) == [("I1", 1), ("I2", 1)]


def test_landing_run_removes_duplicates_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(seen, "drop_exact_duplicates", lambda rows: pytest.fail("trusted rows were de-duplicated again"))
    lines = ["I1,1,1.0,2025-01-01", "I1,1,1.0,2025-01-01", "I2,2,2.0,2025-01-01"]
    for name, chosen in (("a.csv", lines), ("b.csv", [*lines, "I1,2,1.0,2025-01-01"])):
        _put(tmp_path / "landing", name, [HEADER, *chosen])
        plans.run_landing(spark, COMPANY_SALES, str(tmp_path), buckets=2)
    rows = plans.UniqueRows(spark, f"{tmp_path}/unique").read(COMPANY_SALES.typed_schema).collect()
    assert sorted((r["item_id"], r["units_sold"]) for r in rows) == [("I1", 1), ("I1", 2), ("I2", 2)]


def test_paths_have_one_form(spark):
    paths = ["file:/a/b", "file:///a/b", "file:////a", "file:a", "hdfs://h/a+b", "hdfs://h/a%2Bb%20c", "file:///a%20/é+%25", "/a//b", "%66ile:///a", None]
    frame = spark.createDataFrame([(path,) for path in paths], "path string")
    decoded = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    want = frame.select(F.regexp_replace(decoded, r"^file:/+", "file:/")).collect()
    assert frame.select(files.plain_path(F.col("path"))).collect() == want


def test_unique_rows_over_batches(spark, tmp_path):
    unique = plans.UniqueRows(spark, str(tmp_path / "u"))
    schema = COMPANY_SALES.typed_schema
    assert unique.read(schema).count() == 0
    rows = [("I1", 1, 1.0, None), ("I1", 1, 1.0, None), (None, 1, 1.0, None), ("", 1, 1.0, None), ("I2", None, 1.0, None)]

    def add(chosen, batch):
        return unique.add(spark.createDataFrame(chosen, schema), batch)

    assert add(rows[:3], "0") == 2
    assert add(rows, "1") == 2
    for _ in range(2):  # each batch again, as after a run that died
        assert (add(rows[:3], "0"), add(rows, "1")) == (2, 2)
    assert sorted(map(tuple, unique.read(schema).collect()), key=repr) == sorted(set(rows), key=repr)
    assert add([], "2") == 0
