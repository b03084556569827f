import os
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import runs
from tidemark.operators.validate import ErrorRateExceeded
from tidemark.plans.incremental import RunOptions, bucket_count, read_target, run_incremental
from tidemark.session import settings
from tidemark.sinks.keyed import KeyedTable
from tidemark.sources import parquet
from tidemark.state.deadletter import read_failed_log
from tidemark.state.ledger import Ledger, starting_mark

COLUMNS = ["id", "name", "email", "status", "updated_at", "payload"]
NOW = datetime(2025, 5, 22, 3, 0, tzinfo=timezone.utc)


def record(key, day, name="n", **more):
    row = {
        "id": key,
        "name": name,
        "email": f"{name}@example.com",
        "status": "active",
        "updated_at": f"2025-05-{day:02d}T10:00:00",
        "payload": "p",
    }
    row.update(more)
    return row


def deposit(folder, name, rows, columns=None, schema=None):
    path = f"{folder}/raw/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    table = pa.Table.from_pylist(rows, schema=schema)
    if columns:
        table = table.select(columns)
    pq.write_table(table, path)
    return path


def names(spark, root, **kw):
    return {r["id"]: r["name"] for r in read_target(spark, root, **kw).collect()}


def test_days_follow_each_other(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "d1/a.parquet", [record(1, 20, "a"), record(1, 21, "b"), record(2, 20, "c")])
    first = run_incremental(spark, f"{folder}/raw", root, run_id="r1", now=NOW)
    assert (first["files_processed"], first["records_processed"]) == (1, 2)
    assert names(spark, root) == {1: "b", 2: "c"}

    again = run_incremental(spark, f"{folder}/raw", root, run_id="r2", now=NOW)
    assert again["files_processed"] == 0

    deposit(folder, "d2/a.parquet", [record(2, 22, "d"), record(3, 22, "e")], list(reversed(COLUMNS)))
    third = run_incremental(spark, f"{folder}/raw", root, run_id="r3", now=NOW)
    assert third["files_processed"] == 1
    assert names(spark, root) == {1: "b", 2: "d", 3: "e"}
    row = read_target(spark, root).where("id = 3").first()
    assert row["_etl_batch_id"] == "r3"
    assert row["_etl_processed_at"] == datetime(2025, 5, 22, 3, 0)
    assert row["updated_at"] == datetime(2025, 5, 22, 10, 0)


def test_file_deposited_again_is_read_again(spark, folder):
    root = f"{folder}/out"
    path = deposit(folder, "a.parquet", [record(1, 20, "old")])
    run_incremental(spark, f"{folder}/raw", root)
    deposit(folder, "a.parquet", [record(1, 21, "new")])
    os.utime(path, (2_000_000_000, 2_000_000_000))
    assert run_incremental(spark, f"{folder}/raw", root)["files_processed"] == 1
    assert names(spark, root) == {1: "new"}


def test_highwater_skips_old_paths(spark, folder):
    root = f"{folder}/out"
    options = RunOptions(mode="highwater")
    deposit(folder, "b.parquet", [record(1, 20, "b")])
    run_incremental(spark, f"{folder}/raw", root, options)
    mark = Ledger(spark, f"{root}/state").mark()
    assert mark["last_processed_file"].endswith("raw/b.parquet")
    assert mark["records_processed"] == 1
    for name in ("a", "c"):
        path = deposit(folder, f"{name}.parquet", [record(2, 20, name)])
        os.utime(path, (2_000_000_000, 2_000_000_000))
    assert run_incremental(spark, f"{folder}/raw", root, options)["files_processed"] == 1
    assert names(spark, root) == {1: "b", 2: "c"}


def test_mark_stays_when_told_to(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "a.parquet", [record(1, 20)])
    for _ in range(2):
        result = run_incremental(spark, f"{folder}/raw", root, RunOptions(update_mark=False))
        assert result["files_processed"] == 1
    assert Ledger(spark, f"{root}/state").mark() is None
    assert names(spark, root) == {1: "n"}


def test_highwater_from_a_seeded_mark(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "a.parquet", [record(1, 20)])
    ledger = Ledger(spark, f"{root}/state")
    ledger.seed(starting_mark("now"))
    options = RunOptions(mode="highwater")
    assert run_incremental(spark, f"{folder}/raw", root, options)["files_processed"] == 0
    path = deposit(folder, "b.parquet", [record(2, 20)])
    os.utime(path, (2_000_000_000, 2_000_000_000))
    assert run_incremental(spark, f"{folder}/raw", root, options)["files_processed"] == 1
    assert names(spark, root) == {2: "n"}
    other = Ledger(spark, f"{folder}/other")
    other.seed({"last_successful_run": "2025-05-21T00:00:00Z", "last_processed_file": "raw/x", "records_processed": 5})
    assert other.mark()["last_processed_file"] == "raw/x"


@pytest.mark.parametrize(
    "conflict, expected, compact_every",
    [("arrival", "late", 1), ("arrival", "late", 8), ("latest", "early", 2), ("latest", "early", 8)],
)
def test_conflict_modes_whatever_the_compaction(spark, folder, conflict, expected, compact_every):
    root = f"{folder}/out"
    options = RunOptions(conflict=conflict, compact_every=compact_every, buckets=4)
    deposit(folder, "1.parquet", [record(1, 20, "first"), record(9, 20, "other")])
    run_incremental(spark, f"{folder}/raw", root, options)
    deposit(folder, "2.parquet", [record(1, 25, "early")])
    run_incremental(spark, f"{folder}/raw", root, options)
    deposit(folder, "3.parquet", [record(1, 22, "late"), record(4, 22, "four")])
    run_incremental(spark, f"{folder}/raw", root, options)
    assert names(spark, root) == {1: expected, 9: "other", 4: "four"}


@pytest.mark.parametrize(
    "scope, expected",
    # rows of one file, two per slice: (21, a) (25, b) | (20, c) (22, d); then a file with (19, e)
    [("file", "e"), ("batch", "e"), ("run", "b")],
)
def test_scopes_across_files(spark, folder, scope, expected):
    root = f"{folder}/out"
    deposit(folder, "1.parquet", [record(1, d, n) for d, n in [(21, "a"), (25, "b"), (20, "c"), (22, "d")]])
    deposit(folder, "2.parquet", [record(1, 19, "e")])
    run_incremental(spark, f"{folder}/raw", root, RunOptions(scope=scope, batch_size=2))
    assert names(spark, root) == {1: expected}


def test_batch_scope_lets_the_later_slice_win(spark, folder):
    deposit(folder, "1.parquet", [record(1, d, n) for d, n in [(21, "a"), (25, "b"), (20, "c"), (22, "d")]])
    for scope, expected in (("file", "b"), ("batch", "d")):
        root = f"{folder}/{scope}"
        run_incremental(spark, f"{folder}/raw", root, RunOptions(scope=scope, batch_size=2), run_id="r")
        row = read_target(spark, root).first()
        assert row["name"] == expected
        assert row["_etl_batch_id"] == ("r_b2" if scope == "batch" else "r")


def damaged_page(path, rows):
    """A file whose footer is intact while a page of one column is not."""
    table = pa.table(
        {
            "id": list(range(rows)),
            "name": [f"name {i * 7919 % rows}" for i in range(rows)],
            "email": ["e"] * rows,
            "status": ["s"] * rows,
            "updated_at": ["2025-05-20T10:00:00"] * rows,
            "payload": ["p"] * rows,
        }
    )
    pq.write_table(table, path, compression="snappy", use_dictionary=False, row_group_size=rows // 3)
    column = pq.ParquetFile(path).metadata.row_group(1).column(1)
    with open(path, "r+b") as f:
        f.seek(column.data_page_offset)
        f.write(b"\x00" * 400)


def test_bad_files_are_isolated_and_retried(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "good.parquet", [record(1, 20, "a")])
    with open(f"{folder}/raw/not_parquet.parquet", "w") as f:
        f.write("hello")
    deposit(folder, "nokey.parquet", [{"name": "x"}])
    damaged_page(f"{folder}/raw/damaged.parquet", 30_000)
    result = run_incremental(spark, f"{folder}/raw", root, now=NOW)
    assert (result["files_processed"], result["files_failed"]) == (1, 3)
    assert names(spark, root) == {1: "a"}
    log = {r["log_name"].rsplit("_", 1)[1]: r for r in read_failed_log(spark, f"{root}/failed", "2025-05-22").collect()}
    by_name = {r["original_filename"].rsplit("/", 1)[1]: r for r in log.values()}
    assert by_name["damaged.parquet"]["error_type"] == "RowCountMismatch"
    assert by_name["damaged.parquet"]["record_count"] == 30_000
    assert by_name["not_parquet.parquet"]["error_type"] == "ArrowInvalid"
    assert "missing columns ['id']" in by_name["nokey.parquet"]["error_message"]
    assert read_failed_log(spark, f"{root}/failed", "2025-05-23").isEmpty()

    # an unchanged failed file is tried again, a repaired one goes through
    deposit(folder, "nokey.parquet", [record(7, 20, "fixed")])
    second = run_incremental(spark, f"{folder}/raw", root, now=NOW)
    assert (second["files_processed"], second["files_failed"]) == (1, 2)
    assert names(spark, root) == {1: "a", 7: "fixed"}


def test_only_bad_files_commit_nothing_but_the_run(spark, folder):
    os.makedirs(f"{folder}/raw")
    with open(f"{folder}/raw/x.parquet", "w") as f:
        f.write("hello")
    result = run_incremental(spark, f"{folder}/raw", f"{folder}/out")
    assert (result["files_processed"], result["files_failed"], result["records_processed"]) == (0, 1, 0)
    assert read_target(spark, f"{folder}/out").isEmpty()


def test_rows_failing_validation_are_set_aside(spark, folder):
    root = f"{folder}/out"
    rows = [
        record("1", 20, "a"),
        record("1.5", 20, "b"),
        record(None, 20, "c"),
        record("4", 20, "d", updated_at="20 May"),
        record("5", 20, "x" * 256),
        record("6", 20, "f", status="s" * 50),
    ]
    deposit(folder, "a.parquet", rows)
    result = run_incremental(spark, f"{folder}/raw", root, run_id="r")
    assert (result["records_processed"], result["records_failed"]) == (2, 4)
    assert names(spark, root) == {1: "a", 6: "f"}
    bad = spark.read.parquet(f"{root}/quarantine/run_id=r").collect()
    assert sorted(e for r in bad for e in r["_errors"]) == [
        "cast:id", "cast:updated_at", "length:email", "length:name", "null:id",
    ]
    kept = [r["_raw_record"] for r in bad if "cast:id" in r["_errors"]][0]
    assert '"id":"1.5"' in kept


def test_error_rate_gate_stops_the_run(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "a.parquet", [record("x", 20), record("2", 20)])
    with pytest.raises(ErrorRateExceeded):
        run_incremental(spark, f"{folder}/raw", root, RunOptions(max_error_rate=0.001))
    assert Ledger(spark, f"{root}/state").latest() is None
    assert read_target(spark, root).isEmpty()


def test_clashing_schemas_and_missing_columns(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "1.parquet", [record(1, 20, "a"), record(2, 20, "b", payload="keep")])
    narrow = [{"id": 2, "name": None, "updated_at": datetime(2025, 5, 21, 10)}, {"id": 3, "name": "c", "updated_at": datetime(2025, 5, 21)}]
    deposit(
        folder, "2.parquet", narrow,
        schema=pa.schema([("updated_at", pa.timestamp("ns")), ("name", pa.string()), ("id", pa.int32())]),
    )
    deposit(folder, "3.parquet", [record("4", 22, "d", extra=1)])
    result = run_incremental(spark, f"{folder}/raw", root, RunOptions(compact_every=8))
    assert (result["files_processed"], result["files_failed"]) == (3, 0)
    got = {r["id"]: r for r in read_target(spark, root).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[2]["name"] is None and got[2]["payload"] == "keep"
    assert got[2]["updated_at"] == datetime(2025, 5, 21, 10)
    assert got[3]["payload"] is None
    assert "extra" not in read_target(spark, root).columns

    deposit(folder, "4.parquet", [{"id": 1, "payload": "late"}])
    run_incremental(spark, f"{folder}/raw", root, RunOptions(compact_every=2))
    got = {r["id"]: r for r in read_target(spark, root).collect()}
    assert got[1]["name"] == "a" and got[1]["payload"] == "late" and got[2]["payload"] == "keep"


def test_explicit_files_keep_their_order(spark, folder):
    root = f"{folder}/out"
    a = deposit(folder, "a b [1]+%20.parquet", [record(1, 20, "a")])
    b = deposit(folder, "b.parquet", [record(1, 20, "b")])
    result = run_incremental(spark, f"{folder}/raw", root, files=[b, a, f"{folder}/raw/gone.parquet"])
    assert (result["files_processed"], result["files_failed"]) == (2, 1)
    assert names(spark, root) == {1: "a"}
    # what was processed explicitly is known to the ledger
    assert run_incremental(spark, f"{folder}/raw", root)["files_processed"] == 0


def test_latest_mode_takes_files_in_any_order(spark, folder):
    """Every order of the files ends in the same rows, in one run or in several."""
    made = [
        deposit(folder, f"{i}.parquet", [record(k, d, f"{k}-{d}") for k, d in rows])
        for i, rows in enumerate([[(1, 21), (2, 28), (3, 5)], [(1, 25), (2, 20)], [(1, 23), (3, 9), (3, 7)]])
    ]
    want = {1: "1-25", 2: "2-28", 3: "3-9"}
    options = RunOptions(conflict="latest", buckets=2, compact_every=2)
    for n, runs in enumerate([[made], [made[::-1]], [[made[1]], [made[2], made[0]]]]):
        for files in runs:
            run_incremental(spark, "", f"{folder}/{n}", options, files=files)
        assert names(spark, f"{folder}/{n}") == want


def test_partial_rows_where_dates_decide(spark, folder):
    """Each column comes from the latest row that supplies it."""
    root = f"{folder}/out"
    options = RunOptions(conflict="latest", compact_every=9, buckets=2)
    deposit(folder, "1.parquet", [record(1, 22, "a"), record(2, 22, "b")])
    run_incremental(spark, f"{folder}/raw", root, options)
    late, early = {"id": 1, "updated_at": "2025-05-25T10:00:00"}, {"id": 2, "updated_at": "2025-05-01T10:00:00"}
    deposit(folder, "2.parquet", [{**late, "payload": "new"}, {**early, "payload": "old"}])
    run_incremental(spark, f"{folder}/raw", root, options)
    deposit(folder, "3.parquet", [record(1, 24, "c")])
    run_incremental(spark, f"{folder}/raw", root, options)
    got = {r["id"]: (r["name"], r["payload"]) for r in read_target(spark, root).collect()}
    assert got == {1: ("c", "new"), 2: ("b", "p")}


def test_staging_is_removed_after_the_commit(spark, folder):
    root = f"{folder}/it's out"
    deposit(folder, "a.parquet", [record(1, 20)])
    options = RunOptions(compact_every=1, buckets=2, keep_staging=True)
    run_incremental(spark, f"{folder}/raw", root, options, run_id="kept")
    assert os.listdir(f"{root}/staging") == ["kept"]
    deposit(folder, "b.parquet", [record(2, 20)])
    run_incremental(spark, f"{folder}/raw", root, run_id="gone")
    assert os.listdir(f"{root}/staging") == ["kept"]
    assert names(spark, root) == {1: "n", 2: "n"}


@pytest.mark.parametrize("staging", ["rows", "none"])
def test_tasks_of_the_fold_read_small_splits(spark, folder, monkeypatch, staging):
    root, size, seen = f"{folder}/out", "spark.sql.files.maxPartitionBytes", []
    rows = spark.range(0, 600_000, 1, 1).select(
        (F.col("id") % 500_000).alias("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("name"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("updated_at"),
    )
    rows.write.parquet(f"{folder}/raw")
    write = KeyedTable.write_changes
    monkeypatch.setattr(KeyedTable, "write_changes", lambda t, *a: seen.append(spark.conf.get(size)) or write(t, *a))
    before = spark.conf.get(size)
    options = RunOptions(keep_staging=True, staging=staging)
    assert run_incremental(spark, f"{folder}/raw", root, options, run_id="r")["records_processed"] == 500_000
    assert [int(s) <= 16 << 20 for s in seen] == [True] and spark.conf.get(size) == before
    assert read_target(spark, root).where("updated_at >= '1970-01-06 18:53:20'").count() == 100_000
    if staging == "rows":
        staged = [f"{at}/{f}" for at, _, fs in os.walk(f"{root}/staging/r/rows") for f in fs if f.endswith(".parquet")]
        metas = [pq.read_metadata(f) for f in staged]
        groups = [m.row_group(i) for m in metas for i in range(m.num_row_groups)]
        assert sum(g.num_rows for g in groups) == 600_000
        assert max(g.total_byte_size for g in groups) < 24 << 20


def test_input_in_slices_is_sorted_by_several_tasks(spark, folder, monkeypatch):
    rows = [(i * 37 % 3000, i % 211, "OFP"[i % 3], datetime(2024, 1, 1 + i % 28), f"p{i}") for i in range(3000)]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"
    rows += [(None, 211, "O", datetime(2024, 1, 1), "null"), (None, 212, "F", datetime(2024, 1, 1), "null")]
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/orders.parquet")
    monkeypatch.setattr(runs, "scratch_dir", lambda *_: f"{folder}/runs")
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        target = runs.run_scope_batch(spark, folder)
    expected = {}
    for last in (False, True):  # the later file, its later slices, in them the later dates
        part = sorted((r for r in rows if (r[2] == "O") is last), key=lambda r: -1 if r[0] is None else r[0])
        placed = [(n // 500 + 1, r[3], r[0] or 0, r) for n, r in enumerate(part)]
        for piece, _, _, r in sorted(placed, key=lambda p: p[:3]):
            expected[r[1]] = (r[4], f"run_b{piece}")
    assert {r["id"]: (r["payload"], r["_etl_batch_id"]) for r in target.collect()} == expected
    for name in "ab":
        parts = [f for f in os.listdir(f"{folder}/runs/sorted/{name}") if f.endswith(".parquet")]
        assert len(parts) == 4 and os.listdir(f"{folder}/runs/raw/{name}") == ["all.parquet"]


def test_empty_file_and_empty_source(spark, folder):
    root = f"{folder}/out"
    assert run_incremental(spark, f"{folder}/nowhere", root)["files_processed"] == 0
    schema = pa.schema([("id", pa.int64()), ("name", pa.string()), ("updated_at", pa.timestamp("us"))])
    deposit(folder, "a.parquet", [], schema=schema)
    result = run_incremental(spark, f"{folder}/raw", root)
    assert (result["files_processed"], result["records_processed"]) == (1, 0)


def test_crashed_run_leaves_no_trace(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "a.parquet", [record(1, 20, "a")])
    original = Ledger.commit
    Ledger.commit = lambda self, row: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError):
            run_incremental(spark, f"{folder}/raw", root, run_id="r1")
    finally:
        Ledger.commit = original
    assert read_target(spark, root).isEmpty()
    assert run_incremental(spark, f"{folder}/raw", root, run_id="r1")["files_processed"] == 1
    assert names(spark, root) == {1: "a"}
    with pytest.raises(ValueError):
        run_incremental(spark, f"{folder}/raw", root, run_id="r1")


def test_processed_sink_and_defaults(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "a.parquet", [record(1, 20, "a", status=None)])
    options = RunOptions(processed_root=f"{folder}/processed", defaults={"status": "unknown"})
    run_incremental(spark, f"{folder}/raw", root, options, run_id="r", now=NOW)
    rows = spark.read.parquet(f"{folder}/processed").collect()
    assert [(r["status"], str(r["processed_date"]), r["run_id"]) for r in rows] == [("unknown", "2025-05-22", "r")]


def test_base_is_joined_without_a_shuffle(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "1.parquet", [record(i, 20, "a") for i in range(50)])
    run_incremental(spark, f"{folder}/raw", root, RunOptions(compact_every=1, buckets=4))
    deposit(folder, "2.parquet", [record(i, 21, "b") for i in range(10)])
    run_incremental(spark, f"{folder}/raw", root, RunOptions(compact_every=9))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        current = read_target(spark, root)
        plan = current._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the changes only
    assert current.groupBy("name").count().orderBy("name").collect() == [("a", 40), ("b", 10)]
    deposit(folder, "3.parquet", [record(99, 21, "c")])
    run_incremental(spark, f"{folder}/raw", root, RunOptions(compact_every=1), run_id="z")
    files = [f for f in os.listdir(f"{root}/target/base=z") if f.endswith(".parquet")]
    assert len(files) == 4  # one file per bucket
    assert read_target(spark, root).agg(F.count("*"), F.count_distinct("id")).first() == (51, 51)


def test_times_of_every_kind_in_one_run(spark, folder):
    """96-bit, milli-, micro- and nanosecond times, with and without a zone, mean the same moment."""
    root = f"{folder}/out"
    moment = datetime(2025, 5, 20, 10, 0, 0)
    kinds = {
        1: pa.timestamp("ms"), 2: pa.timestamp("us"), 3: pa.timestamp("ns"), 4: pa.timestamp("us", "UTC"),
    }
    for key, kind in kinds.items():
        row = {**record(key, 20, "n"), "updated_at": moment}
        rows = pa.Table.from_pylist([row])
        place = rows.schema.get_field_index("updated_at")
        rows = rows.set_column(place, "updated_at", pa.array([moment], pa.timestamp("us")).cast(kind))
        os.makedirs(f"{folder}/raw", exist_ok=True)
        pq.write_table(rows, f"{folder}/raw/{key}.parquet")
    row = {**record(5, 20, "n"), "updated_at": moment}
    pq.write_table(pa.Table.from_pylist([row]), f"{folder}/raw/5.parquet", use_deprecated_int96_timestamps=True)
    made = run_incremental(spark, f"{folder}/raw", root, run_id="r1", now=NOW)
    assert (made["files_processed"], made["files_failed"]) == (5, 0)
    assert {r["id"]: r["updated_at"] for r in read_target(spark, root).collect()} == dict.fromkeys(range(1, 6), moment)


def test_of_two_runs_on_one_state_one_commits(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "a.parquet", [record(1, 20, "a")])
    first = Ledger(spark, f"{root}/state")
    run_incremental(spark, f"{folder}/raw", root, run_id="r1", now=NOW)
    deposit(folder, "b.parquet", [record(2, 20, "b")])
    with pytest.raises(RuntimeError, match="another run"):
        first.commit({"run_id": "late", "version": 1, "last_successful_run": NOW.isoformat()})
    run_incremental(spark, f"{folder}/raw", root, run_id="r2", now=NOW)
    assert names(spark, root) == {1: "a", 2: "b"}


def test_failed_file_stays_due_beyond_the_mark(spark, folder):
    root, options = f"{folder}/out", RunOptions(mode="highwater")
    broken = deposit(folder, "a.parquet", [record(1, 20, "a")])
    with open(broken, "wb") as file:
        file.write(b"broken")
    deposit(folder, "b.parquet", [record(2, 20, "b")])
    first = run_incremental(spark, f"{folder}/raw", root, options, run_id="r1", now=NOW)
    assert (first["files_processed"], first["files_failed"]) == (1, 1)
    deposit(folder, "a.parquet", [record(1, 21, "mended")])
    second = run_incremental(spark, f"{folder}/raw", root, options, run_id="r2", now=NOW)
    assert second["files_processed"] == 1 and names(spark, root) == {1: "mended", 2: "b"}


def test_target_keeps_its_rule(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "a.parquet", [record(1, 22, "new")])
    run_incremental(spark, f"{folder}/raw", root, RunOptions(conflict="latest"), run_id="r1", now=NOW)
    deposit(folder, "b.parquet", [record(1, 20, "old")])
    with pytest.raises(ValueError, match="conflict"):
        run_incremental(spark, f"{folder}/raw", root, RunOptions(conflict="arrival"), run_id="r2", now=NOW)
    run_incremental(spark, f"{folder}/raw", root, RunOptions(conflict="latest"), run_id="r3", now=NOW)
    assert names(spark, root) == {1: "new"}


def test_buckets_can_change(spark, folder):
    root = f"{folder}/out"
    for n, buckets in ((1, 2), (2, 4), (3, None)):
        deposit(folder, f"{n}.parquet", [record(k, 20 + n, f"{n}") for k in range(n, 40 + n)])
        options = RunOptions(compact_every=1, buckets=buckets)
        run_incremental(spark, f"{folder}/raw", root, options, run_id=f"r{n}", now=NOW)
        assert Ledger(spark, f"{root}/state").latest()["buckets"] == (buckets or 4)
    assert names(spark, root) == {1: "1", 2: "2", **dict.fromkeys(range(3, 43), "3")}
    assert bucket_count(10, None, 4) == 3 and bucket_count(100, 3, 4) == 24 and bucket_count(8, 3, 4) == 3


def test_gate_leaves_evidence_and_repeats_do_not_double_it(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "a.parquet", [record(1, 20, "a"), record(None, 20, "b")])
    with open(deposit(folder, "b.parquet", [record(2, 20, "b")]), "wb") as file:
        file.write(b"broken")
    for _ in range(2):
        with pytest.raises(ErrorRateExceeded):
            run_incremental(spark, f"{folder}/raw", root, RunOptions(max_error_rate=0.1), run_id="r1", now=NOW)
    assert read_failed_log(spark, f"{root}/failed").count() == 1
    assert spark.read.parquet(f"{root}/quarantine/run_id=r1").count() == 1
    assert Ledger(spark, f"{root}/state").latest() is None


def test_storage_errors_are_no_bad_files(monkeypatch):
    from pyarrow import fs

    def refused(self, path):
        raise OSError("When reading information for key: AWS Error ACCESS_DENIED")

    check = parquet._footer_check(["id"], ["id"])
    monkeypatch.setattr(fs, "LocalFileSystem", type("Refused", (), {"get_file_info": refused}))
    with pytest.raises(OSError, match="ACCESS_DENIED"):
        list(check(iter([pd.DataFrame({"path": ["/x/a.parquet"]})])))


def test_partial_rows_in_any_order_and_grouping(spark, folder):
    """Whatever runs the files come in, and whenever the base is rewritten, each column is the latest."""
    made = [
        deposit(folder, "1.parquet", [record(1, 26, "base"), record(2, 20, "two")]),
        deposit(folder, "2.parquet", [record(1, 25, "stale"), record(3, 21, "three")]),
        deposit(folder, "3.parquet", [record(k, 27, "part", payload=f"new{k}") for k in (1, 2, 4)], ["id", "updated_at", "payload"]),
    ]
    day = {r: datetime(2025, 5, r, 10) for r in (21, 27)}
    want = {
        1: ("base", "new1", day[27]), 2: ("two", "new2", day[27]), 3: ("three", "p", day[21]), 4: (None, "new4", day[27]),
    }
    n = 0
    for order in ([0, 1, 2], [2, 1, 0], [1, 2, 0]):
        for runs in ([order], [order[:1], order[1:]], [[i] for i in order]):
            for every in (1, 8):
                n += 1
                if n % 2 and len(runs) == 1:
                    continue
                options = RunOptions(conflict="latest", compact_every=every, buckets=2)
                for files in runs:
                    run_incremental(spark, "", f"{folder}/{n}", options, files=[made[i] for i in files])
                got = {r["id"]: (r["name"], r["payload"], r["updated_at"]) for r in read_target(spark, f"{folder}/{n}").collect()}
                assert got == want, (order, runs, every)
