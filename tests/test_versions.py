"""The ledger as a log, segments of the base, concurrent runs, earlier versions, expiry, new columns and replays."""

import json
import os
import random
import shutil
import time
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks.changes import upsert_arrival
from tests.test_incremental import COLUMNS, NOW, damaged_page, deposit, names, record
from tidemark.plans import incremental, replay
from tidemark.plans.expiry import expire, unreferenced
from tidemark.plans.incremental import RunOptions, read_target, run_changes, run_incremental, target_diff
from tidemark.sinks.keyed import KeyedTable, segments_of
from tidemark.sources import discovery, parquet
from tidemark.sources.listing import list_files
from tidemark.state import ledger as ledgers
from tidemark.state.ledger import Ledger, Superseded


def rows_of(spark, root, **kw):
    return sorted(read_target(spark, root, **kw).collect())


# --- the ledger


@pytest.mark.parametrize("left", ["", '{"run_id": "r2", "ver', "[1]\n", "{}\n"])
def test_version_file_of_a_dead_writer_is_passed_over(spark, folder, left):
    root = f"{folder}/out"
    deposit(folder, "a.parquet", [record(1, 20, "a")])
    run_incremental(spark, f"{folder}/raw", root, run_id="r1", now=NOW)
    with open(f"{root}/state/runs/version-000000000002.json", "w") as f:
        f.write(left)
    assert Ledger(spark, f"{root}/state").latest()["run_id"] == "r1"
    deposit(folder, "b.parquet", [record(2, 20, "b")])
    run_incremental(spark, f"{folder}/raw", root, run_id="r3", now=NOW)
    assert names(spark, root) == {1: "a", 2: "b"}
    ledger = Ledger(spark, f"{root}/state")
    assert ledger.latest()["version"] == 3
    assert sorted(r["run_id"] for r in ledger.runs().collect()) == ["r1", "r3"]


def test_a_published_file_is_whole_and_never_replaced(spark, folder):
    from tidemark.session import list_names, publish_text, read_text

    path = f"{folder}/new/x.json"
    assert publish_text(spark, path, "é1") and not publish_text(spark, path, "2")
    assert read_text(spark, path) == "é1" and list_names(spark, f"{folder}/new") == ["x.json"]
    assert list_names(spark, f"{folder}/nowhere") == []


def test_a_thousand_runs_are_read_from_two_files(spark, folder, monkeypatch):
    """990 of them as files of one row each, as they were written before checkpoints."""
    os.makedirs(f"{folder}/state/runs")

    def row(i):
        at = f"2025-01-01T00:00:00.{i:06d}+00:00"
        return {"version": i, "run_id": f"r{i}", "last_successful_run": at, "watermark_id": "w", "advances_mark": i % 2 == 1}

    for i in range(1, 991):
        with open(f"{folder}/state/runs/version-{i:012d}.json", "w") as f:
            f.write(json.dumps(row(i)) + "\n")
    ledger = Ledger(spark, f"{folder}/state", checkpoint_every=4)
    for i in range(991, 1001):
        ledger.commit(row(i))
    opened = []
    read = ledgers.read_text
    monkeypatch.setattr(ledgers, "read_text", lambda spark, path: opened.append(path) or read(spark, path))
    runs = ledger.runs()
    files = [f for f in runs.inputFiles() if not f.endswith("_SUCCESS")]
    assert len(opened) == 1 and len(files) == 1
    assert runs.agg(F.count("*"), F.count_distinct("run_id"), F.max("version")).first() == (1000, 1000, 1000)
    assert ledger.latest()["run_id"] == "r1000" and ledger.has("r1") and not ledger.has("r0")
    assert ledger.mark()["last_successful_run"].startswith("2025-01-01T00:00:00.000999")
    assert ledger.as_of(417)["run_id"] == "r417" and ledger.before(417)["run_id"] == "r416"


def test_checkpoint_keeps_what_files_did(spark, folder):
    """The same runs with and without checkpoints leave the same files done, and failed."""
    for every in (1, 100):
        root = f"{folder}/{every}"
        options = RunOptions(checkpoint_every=every)
        for day in (1, 2, 3):
            path = deposit(f"{folder}/in{every}", f"{day}.parquet", [record(day, 20 + day, "n")])
            if day == 2:
                with open(path, "w") as f:
                    f.write("broken")
            run_incremental(spark, f"{folder}/in{every}/raw", root, options, run_id=f"r{day}", now=NOW)
        ledger = Ledger(spark, f"{root}/state", every)
        done = {(r["path"][-9:], r["status"], r["run_id"]) for r in ledger.files().collect()}
        assert done == {("1.parquet", "ok", "r1"), ("2.parquet", "failed", "r3"), ("3.parquet", "ok", "r3")}
        assert [r["path"][-9:] for r in ledger.failed().collect()] == ["2.parquet"]
        assert run_incremental(spark, f"{folder}/in{every}/raw", root, options, now=NOW)["files_failed"] == 1


def test_ledger_of_single_rows_is_read_on(spark, folder):
    """Version files with one row each, as they were written before checkpoints, still count."""
    os.makedirs(f"{folder}/state/runs")
    for i in (1, 2, 3):
        row = {"version": i, "run_id": f"r{i}", "last_successful_run": NOW.isoformat(), "watermark_id": "w", "advances_mark": True}
        with open(f"{folder}/state/runs/version-{i:012d}.json", "w") as f:
            f.write(json.dumps(row) + "\n")
    ledger = Ledger(spark, f"{folder}/state", checkpoint_every=4)
    for i in (4, 5):
        ledger.commit({"version": i, "run_id": f"r{i}", "last_successful_run": NOW.isoformat(), "watermark_id": "w"})
    assert sorted(r["run_id"] for r in ledger.runs().collect()) == ["r1", "r2", "r3", "r4", "r5"]
    assert ledger.latest()["checkpoint_version"] == 4


# --- concurrent runs


def interleave(monkeypatch, between):
    """Let ``between`` happen just before the next commit."""
    commit, calls = Ledger.commit, []

    def patched(self, row):
        if not calls:
            calls.append(1)
            between()
        return commit(self, row)

    monkeypatch.setattr(Ledger, "commit", patched)


@pytest.mark.parametrize("options", [
    RunOptions(), RunOptions(compact_every=1, buckets=3), RunOptions(track_changes=True), RunOptions(conflict="latest"),
])
def test_runs_of_different_files_both_count(spark, folder, monkeypatch, options):
    root = f"{folder}/out"
    base = deposit(folder, "0.parquet", [record(k, 20, "old") for k in range(5)])
    run_incremental(spark, "", root, options, files=[base], run_id="r0", now=NOW)
    a = deposit(folder, "a.parquet", [record(1, 22, "a"), record(7, 22, "a")])
    b = deposit(folder, "b.parquet", [record(1, 21, "b"), record(7, 22, "a"), record(8, 22, "b")])
    interleave(monkeypatch, lambda: run_incremental(spark, "", root, options, files=[b], run_id="rb", now=NOW))
    run_incremental(spark, "", root, options, files=[a], run_id="ra", now=NOW)
    assert names(spark, root) == {0: "old", 1: "a", 2: "old", 3: "old", 4: "old", 7: "a", 8: "b"}
    ledger = Ledger(spark, f"{root}/state")
    assert [r["run_id"] for r in ledger.runs().orderBy("version").collect()] == ["r0", "rb", "ra"]
    if options.track_changes:  # key 7 was new when the run looked, and is no longer
        kinds = {r["id"]: r["_change_type"] for r in run_changes(spark, root, "ra").collect()}
        assert kinds == {1: "update", 7: "unchanged"}


def test_the_same_file_twice_is_refused(spark, folder, monkeypatch):
    root = f"{folder}/out"
    deposit(folder, "a.parquet", [record(1, 22, "a")])
    interleave(monkeypatch, lambda: run_incremental(spark, f"{folder}/raw", root, run_id="first", now=NOW))
    with pytest.raises(Superseded, match="some of these files"):
        run_incremental(spark, f"{folder}/raw", root, run_id="second", now=NOW)
    assert read_target(spark, root).first()["_etl_batch_id"] == "first"
    assert run_incremental(spark, f"{folder}/raw", root)["files_processed"] == 0


# --- segments


def files_of(root):
    return {f"{d}/{f}" for d in os.listdir(f"{root}/target") if d.startswith("base=")
            for f in os.listdir(f"{root}/target/{d}") if f.endswith(".parquet")}


@pytest.mark.parametrize("conflict", ["arrival", "latest"])
def test_a_run_of_one_key_writes_one_bucket(spark, folder, conflict):
    root, options = f"{folder}/out", RunOptions(compact_every=1, buckets=16, conflict=conflict)
    deposit(folder, "0.parquet", [record(k, 20, f"n{k}") for k in range(300)])
    run_incremental(spark, f"{folder}/raw", root, options, run_id="r0", now=NOW)
    before = files_of(root)
    assert len(before) == 16
    for n, key in enumerate((7, 8, 7, 1000), 1):
        deposit(folder, f"{n}.parquet", [record(key, 20 + n, f"new{n}")])
        run_incremental(spark, f"{folder}/raw", root, options, run_id=f"r{n}", now=NOW)
    assert before <= files_of(root) and len(files_of(root)) == 20
    state = Ledger(spark, f"{root}/state").latest()
    assert state["pending"] == [] and len(state["segments"]) >= 3
    want = {k: f"n{k}" for k in range(300)} | {7: "new3", 8: "new2", 1000: "new4"}
    assert names(spark, root) == want

    # Files of buckets that a later folder holds are not opened.
    current = {s.folder: s.buckets for s in segments_of(state["segments"], 16)}
    stale = [f for f in files_of(root) if int(f.split("_")[-1][:5]) not in current.get(f.split("/")[0], ())]
    assert stale
    for f in stale:
        with open(f"{root}/target/{f}", "w") as out:
            out.write("damaged")
        crc = f"{root}/target/{os.path.dirname(f)}/.{os.path.basename(f)}.crc"
        if os.path.exists(crc):
            os.truncate(crc, 0)
    assert names(spark, root) == want

    # The same rows as a whole rewrite, and the same when all buckets change.
    table = KeyedTable(spark, f"{root}/target", conflict=conflict)
    whole = table.rewrite(state["segments"], [], 5, "whole", 16)
    assert [(s["folder"], s["buckets"]) for s in whole] == [("base=whole", None)]
    assert sorted(table.read(whole, [], 5).collect()) == rows_of(spark, root)
    deposit(folder, "9.parquet", [record(k, 29, "all") for k in range(300)])
    run_incremental(spark, f"{folder}/raw", root, options, run_id="r9", now=NOW)
    assert len(Ledger(spark, f"{root}/state").latest()["segments"]) == 1
    assert names(spark, root) == dict.fromkeys(range(300), "all") | {1000: "new4"}


def test_segments_are_bounded_and_read_without_a_shuffle(spark, folder):
    root, options = f"{folder}/out", RunOptions(compact_every=1, buckets=64)
    deposit(folder, "0.parquet", [record(k, 20, "n") for k in range(500)])
    run_incremental(spark, f"{folder}/raw", root, options, run_id="r0", now=NOW)
    for n in range(1, 9):
        deposit(folder, f"{n}.parquet", [record(n * 17, 21, "m")])
        run_incremental(spark, f"{folder}/raw", root, options, run_id=f"r{n}", now=NOW)
        assert len(Ledger(spark, f"{root}/state").latest()["segments"]) <= 8
    deposit(folder, "z.parquet", [record(3, 21, "z")])
    run_incremental(spark, f"{folder}/raw", root, RunOptions(compact_every=9), run_id="z", now=NOW)
    state = Ledger(spark, f"{root}/state").latest()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = read_target(spark, root)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Bucketed: true") == len(state["segments"]) == plan.count("Exchange hashpartitioning")
        table = KeyedTable(spark, f"{root}/target")
        found = table.key_conflicts(state.asDict(recursive=True), spark.range(2, 5))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for scan in [line for line in plan.splitlines() if "Bucketed: true" in line]:
        above = plan[: plan.index(scan)].splitlines()[-1]
        assert "Exchange" not in above
    assert sorted((r["id"], r["stored"], r["incoming"]) for r in found.collect()) == [(2, 1, 1), (3, 1, 1), (4, 1, 1)]
    assert read_target(spark, root).count() == 500


def test_key_conflicts(spark, folder):
    schema = spark.createDataFrame([], "a int, b string, v int").schema
    table = KeyedTable(spark, folder, schema, ["a", "b"], "v")
    rows = lambda *r: spark.createDataFrame(r, schema)
    base = table.rewrite(None, [table.write_changes(rows((1, "x", 1), (2, "x", 1)), "1")], 4, "1")
    pending = table.write_changes(rows((3, "x", 1), (1, "x", 2)), "2")
    incoming = rows((1, "x", 5), (3, "x", 5), (4, "x", 5), (5, "x", 5), (5, "x", 6), (6, None, 1))
    for state in ({"base": None, "segments": base, "pending": [pending], "buckets": 4},):
        got = {(r["a"], r["b"]): (r["stored"], r["incoming"]) for r in table.key_conflicts(state, incoming).collect()}
        assert got == {(1, "x"): (1, 1), (3, "x"): (1, 1), (5, "x"): (0, 2), (6, None): (0, 1)}
    empty = {"base": None, "segments": None, "pending": [], "buckets": None}
    assert table.key_conflicts(empty, incoming).count() == 2


def test_upsert_evaluates_its_updates_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = upsert_arrival(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("FileScan") == 2


# --- earlier versions


def test_earlier_versions_and_what_changed(spark, folder):
    root, options = f"{folder}/out", RunOptions(compact_every=2, buckets=2, track_changes=True)
    times = [NOW + timedelta(days=i) for i in range(4)]
    deposit(folder, "0.parquet", [record(1, 20, "a"), record(2, 20, "b")])
    run_incremental(spark, f"{folder}/raw", root, options, run_id="r0", now=times[0])
    deposit(folder, "1.parquet", [record(2, 20, "b"), record(3, 20, "c")])
    second = run_incremental(spark, f"{folder}/raw", root, options, run_id="r1", now=times[1])
    assert (second["inserted"], second["updated"], second["unchanged"], second["stale"]) == (1, 0, 1, 0)
    assert read_target(spark, root).where("id = 2").first()["_etl_batch_id"] == "r0"  # it did not change
    deposit(folder, "2.parquet", [record(1, 21, "z"), record(4, 20, "d")])
    run_incremental(spark, f"{folder}/raw", root, options, run_id="r2", now=times[2])
    versions = [{1: "a", 2: "b"}, {1: "a", 2: "b", 3: "c"}, {1: "z", 2: "b", 3: "c", 4: "d"}]
    for i, want in enumerate(versions):
        for as_of in (i + 1, f"r{i}", times[i], times[i] + timedelta(hours=1)):
            assert names(spark, root, as_of=as_of) == want
    with pytest.raises(ValueError, match="no run"):
        read_target(spark, root, as_of=NOW - timedelta(days=1))
    diff = lambda a, b=None: {(r["id"], r["name"], r["_change_type"]) for r in target_diff(spark, root, a, b).collect()}
    assert diff(1) == {(3, "c", "insert"), (1, "z", "update"), (4, "d", "insert")}
    assert diff(1, 2) == {(3, "c", "insert")} and diff(3) == set()
    kinds = lambda run: {r["id"]: r["_change_type"] for r in run_changes(spark, root, run).collect()}
    assert kinds("r1") == {2: "unchanged", 3: "insert"} and kinds(3) == {1: "update", 4: "insert"}


def test_changes_of_a_run_that_did_not_track_them(spark, folder):
    root, options = f"{folder}/out", RunOptions(conflict="latest")
    deposit(folder, "0.parquet", [record(1, 20, "a"), record(2, 22, "b"), record(3, 20, "c")])
    run_incremental(spark, f"{folder}/raw", root, options, run_id="r0", now=NOW)
    deposit(folder, "1.parquet", [record(1, 21, "a"), record(2, 21, "old"), record(3, 20, "c"), record(4, 1, "d")])
    run_incremental(spark, f"{folder}/raw", root, options, run_id="r1", now=NOW)
    kinds = {r["id"]: r["_change_type"] for r in run_changes(spark, root, "r1").collect()}
    assert kinds == {1: "update", 2: "stale", 3: "unchanged", 4: "insert"}
    assert {r["_change_type"] for r in run_changes(spark, root, "r0").collect()} == {"insert"}


@pytest.mark.parametrize("conflict", ["arrival", "latest"])
def test_tracking_gives_the_same_target(spark, folder, conflict):
    """Rows of several columns in several runs: what is not stored as a change changed nothing."""
    days = [
        [record(1, 22, "a"), record(2, 22, "b"), record(3, 22, "c")],
        [record(1, 21, "old"), record(2, 22, "b"), record(4, 22, "d")],
        [{k: v for k, v in record(n, 23, "x", payload=f"p{n}").items() if k in ("id", "updated_at", "payload")} for n in (1, 4, 5)],
    ]
    for track in (False, True):
        options = RunOptions(conflict=conflict, track_changes=track, compact_every=2, buckets=2)
        for i, rows in enumerate(days):
            path = deposit(f"{folder}/{track}", f"{i}.parquet", rows)
            run_incremental(spark, "", f"{folder}/{track}/out", options, files=[path], run_id=f"r{i}", now=NOW)
    plain, tracked = (read_target(spark, f"{folder}/{t}/out").drop("_etl_batch_id") for t in (False, True))
    assert sorted(plain.collect()) == sorted(tracked.collect())


def test_a_rewrite_waits_for_its_share(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "0.parquet", [record(k, 20, f"{k * 7919}" * 20) for k in range(3000)])
    run_incremental(spark, f"{folder}/raw", root, RunOptions(compact_every=1, buckets=2), run_id="r0", now=NOW)
    options = RunOptions(compact_every=2, compact_share=0.9, buckets=2)
    seen = []
    for n in range(1, 8):
        deposit(folder, f"{n}.parquet", [record(n, 21, "x")])
        run_incremental(spark, f"{folder}/raw", root, options, run_id=f"r{n}", now=NOW)
        seen.append(len(Ledger(spark, f"{root}/state").latest()["pending"]))
    assert seen == [1, 2, 3, 4, 5, 0, 1]  # three times as long, as the changes are few


# --- expiry


def age(path, days):
    old = time.time() - days * 86400
    for folder, _, files in os.walk(path):
        for f in files:
            os.utime(f"{folder}/{f}", (old, old))


def test_expiry_spares_what_is_referenced_and_what_is_in_progress(spark, folder):
    root, options = f"{folder}/out", RunOptions(compact_every=2, buckets=4, checkpoint_every=2)
    for n in range(6):
        deposit(folder, f"{n}.parquet", [record(k, 20, f"{n}") for k in range(n, 20)])
        run_incremental(spark, f"{folder}/raw", root, options, run_id=f"r{n}", now=NOW)
    kept = {v: rows_of(spark, root, as_of=v) for v in (4, 5, 6)}
    # A run that has died, and one in progress.
    for run, days in (("dead", 9), ("busy", 0)):
        shutil.copytree(f"{root}/target/changes=r5", f"{root}/target/changes={run}")
        shutil.copytree(f"{root}/target/changes=r5", f"{root}/staging/{run}/rows")
    age(root, 9)
    for path in (f"{root}/target/changes=busy", f"{root}/staging/busy"):
        for d, _, files in os.walk(path):
            for f in files:
                os.utime(f"{d}/{f}")
    listed = {(r["area"], r["folder"]) for r in unreferenced(spark, root, 3).collect()}
    assert ("target", "changes=dead") in listed and ("staging", "dead") in listed
    assert not any(name in ("changes=busy", "busy") for _, name in listed)
    gone = expire(spark, root, 3)
    assert {f"{a}/{f}" for a, f in listed} <= set(gone)
    assert "target/changes=r0" in gone and "state/runs/version-000000000001.json" in gone
    for version, rows in kept.items():
        assert rows_of(spark, root, as_of=version) == rows
    assert target_diff(spark, root, 4, 6).count() > 0
    with pytest.raises(Exception):
        rows_of(spark, root, as_of=1)
    assert run_incremental(spark, f"{folder}/raw", root, options)["files_processed"] == 0  # files are still known
    deposit(folder, "9.parquet", [record(99, 20, "late")])
    run_incremental(spark, f"{folder}/raw", root, options, run_id="r9", now=NOW)
    assert names(spark, root)[99] == "late" and len(names(spark, root)) == 21
    assert expire(spark, f"{folder}/nothing") == []
    with pytest.raises(ValueError):
        expire(spark, root, 0)


# --- columns


def test_left_out_columns_are_recorded(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "a.parquet", [record(1, 20, "a", country="x", tags=["t"])])
    deposit(folder, "b.parquet", [record(2, 20, "b", country="y")])
    run_incremental(spark, f"{folder}/raw", root, run_id="r0", now=NOW)
    row = Ledger(spark, f"{root}/state").runs().first()
    assert row["left_out"] == {"country": 2, "tags": 1} and row["columns"] is None
    assert "country" not in read_target(spark, root).columns


def test_columns_are_added(spark, folder):
    root, options = f"{folder}/out", RunOptions(extra_columns="add", compact_every=3, buckets=4)
    deposit(folder, "0.parquet", [record(1, 20, "a"), record(2, 20, "b")])
    run_incremental(spark, f"{folder}/raw", root, options, run_id="r0", now=NOW)
    deposit(folder, "1.parquet", [record(2, 21, "b2", Country="de", score=1, tags=["t"], _own=1)])
    deposit(folder, "2.parquet", [record(3, 21, "c", country="fr", mixed=1)])
    deposit(folder, "3.parquet", [record(4, 21, "d", mixed="one")])
    run_incremental(spark, f"{folder}/raw", root, options, run_id="r1", now=NOW)
    row = Ledger(spark, f"{root}/state").latest()
    assert row["left_out"] == {"tags": 1, "_own": 1}
    got = read_target(spark, root)
    assert dict(got.dtypes)["mixed"] == "string" and dict(got.dtypes)["score"] == "bigint"
    lower = {c: c.lower() for c in got.columns}
    found = {r["id"]: (r["country"], r["score"], r["mixed"]) for r in got.withColumnsRenamed(lower).collect()}
    assert found == {1: (None, None, None), 2: ("de", 1, None), 3: ("fr", None, "1"), 4: (None, None, "one")}
    # A file without them keeps them; a value of the wrong kind is set aside; "drop" goes on with known columns.
    deposit(folder, "4.parquet", [record(2, 22, "b3")])
    deposit(folder, "5.parquet", [record(5, 22, "e", score="7"), record(6, 22, "f", score="many")])
    third = run_incremental(spark, f"{folder}/raw", root, RunOptions(compact_every=3, buckets=4), run_id="r2", now=NOW)
    assert (third["records_processed"], third["records_failed"]) == (2, 1)
    found = {r["id"]: (r["name"], r["score"]) for r in read_target(spark, root).collect()}
    assert found == {1: ("a", None), 2: ("b3", 1), 3: ("c", None), 4: ("d", None), 5: ("e", 7)}
    assert Ledger(spark, f"{root}/state").latest()["segments"]
    assert "score" not in read_target(spark, root, as_of="r0").columns
    assert {r["id"]: r["score"] for r in read_target(spark, root, as_of="r1").collect()} == {1: None, 2: 1, 3: None, 4: None}


def test_two_runs_that_add_a_column(spark, folder, monkeypatch):
    root, options = f"{folder}/out", RunOptions(extra_columns="add")
    a = deposit(folder, "a.parquet", [record(1, 20, "a", x=1, same="s")])
    b = deposit(folder, "b.parquet", [record(2, 20, "b", y=2, same="t")])
    interleave(monkeypatch, lambda: run_incremental(spark, "", root, options, files=[b], run_id="rb", now=NOW))
    run_incremental(spark, "", root, options, files=[a], run_id="ra", now=NOW)
    found = {r["id"]: (r["x"], r["y"], r["same"]) for r in read_target(spark, root).collect()}
    assert found == {1: (1, None, "s"), 2: (None, 2, "t")}


# --- waves


def mixed_files(folder):
    for n in range(12):
        rows = [record(k, 20 + (n * k) % 5, f"{n}-{k}") for k in range(n, n + 6)]
        rows.append(record(None, 20, f"{n}"))
        deposit(folder, f"{n:02d}.parquet", rows, COLUMNS if n % 3 else ["id", "updated_at", "name"])
    with open(f"{folder}/raw/zz.parquet", "w") as f:
        f.write("broken")
    damaged_page(f"{folder}/raw/yy.parquet", 30_000)


@pytest.mark.parametrize("conflict", ["arrival", "latest"])
def test_waves_of_files_and_reading_twice_give_the_same(spark, folder, conflict):
    mixed_files(folder)
    want = None
    for staging in ("rows", "none"):
        for size in (1000, 5, 1):
            root, options = f"{folder}/{staging}{size}", RunOptions(wave_files=size, staging=staging, conflict=conflict)
            if size == 1 and conflict == "latest":
                continue
            done = run_incremental(spark, f"{folder}/raw", root, options, run_id="r", now=NOW)
            assert (done["files_processed"], done["files_failed"], done["records_failed"]) == (12, 2, 12)
            want = want or rows_of(spark, root)
            assert rows_of(spark, root) == want and len(want) == 17
            assert spark.read.parquet(f"{root}/quarantine").count() == 12


def test_reading_twice_stores_little(spark, folder):
    rng = random.Random(1)
    for n in range(3):
        rows = [record(k, 20 + n, f"{rng.random()}", payload=f"{rng.random()}" * 5) for k in range(2000)] * 10
        deposit(folder, f"{n}.parquet", rows)
    size = sum(os.path.getsize(f"{folder}/raw/{f}") for f in os.listdir(f"{folder}/raw"))
    staged = {}
    for staging in ("rows", "none"):
        options = RunOptions(staging=staging, keep_staging=True, scope="run", track_changes=staging == "none")
        run_incremental(spark, f"{folder}/raw", f"{folder}/{staging}", options, run_id="r", now=NOW)
        stage = f"{folder}/{staging}/staging"
        staged[staging] = sum(os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(stage) for f in fs)
    assert staged["none"] < 0.1 * size < staged["rows"]
    rows, none = (read_target(spark, f"{folder}/{s}") for s in ("rows", "none"))
    assert sorted(rows.collect()) == sorted(none.collect()) and rows.count() == 2000


def test_a_file_replaced_between_the_reads_is_refused(spark, folder, monkeypatch):
    root, options = f"{folder}/out", RunOptions(staging="none")
    deposit(folder, "a.parquet", [record(1, 20, "old")])
    again = incremental._Reader.again

    def patched(self, ok):
        deposit(folder, "a.parquet", [record(1, 20, "new")])
        os.utime(f"{folder}/raw/a.parquet", (2_000_000_000, 2_000_000_000))
        return again(self, ok)

    monkeypatch.setattr(incremental._Reader, "again", patched)
    with pytest.raises(RuntimeError, match="changed while"):
        run_incremental(spark, f"{folder}/raw", root, options, now=NOW)
    monkeypatch.setattr(incremental._Reader, "again", again)
    assert read_target(spark, root).isEmpty()
    run_incremental(spark, f"{folder}/raw", root, options, now=NOW)
    assert names(spark, root) == {1: "new"}


# --- discovery


def listed(spark, folder, since=None):
    found = discovery.changed_listing(spark, f"{folder}/raw", f"{folder}/listing", since)
    cut = len(f"file:{folder}/raw")
    want = {(r["path"], r["modificationTime"], r["length"]) for r in list_files(spark, f"{folder}/raw").collect()}
    assert {(r["path"], r["modificationTime"], r["length"]) for r in found.files.collect()} == want
    return sorted(f[cut:] for f in found.listed)


def settle(folder):
    """All folders as if nothing had happened to them for an hour."""
    for d, _, _ in os.walk(f"{folder}/raw", topdown=False):
        t = os.stat(d).st_mtime_ns - 3_600_000_000_000
        os.utime(d, ns=(t, t))


def test_only_changed_folders_are_listed(spark, folder):
    assert discovery.changed_listing(spark, f"{folder}/raw", f"{folder}/listing").files.count() == 0
    for day in range(1, 6):
        for n in range(3):
            deposit(folder, f"2025-05-{day:02d}/{n} [x].parquet", [record(n, day)])
    deposit(folder, "top.parquet", [record(1, 20)])
    settle(folder)
    days = [f"/2025-05-{d:02d}" for d in range(1, 6)]
    assert listed(spark, folder) == ["", *days]
    assert listed(spark, folder) == [""]  # the root holds folders
    # A file replaced in an old folder, one added, one removed, a new folder.
    deposit(folder, "aside.parquet", [record(9, 20)])
    os.replace(f"{folder}/raw/aside.parquet", f"{folder}/raw/2025-05-02/1 [x].parquet")
    deposit(folder, "2025-05-04/new.parquet", [record(9, 20)])
    os.remove(f"{folder}/raw/2025-05-05/0 [x].parquet")
    deposit(folder, "2025-05-06/sub/a.parquet", [record(9, 20)])
    changed = ["", "/2025-05-02", "/2025-05-04", "/2025-05-05", "/2025-05-06", "/2025-05-06/sub"]
    assert listed(spark, folder) == changed
    assert listed(spark, folder) == changed  # so young that they may have changed again
    settle(folder)
    listed(spark, folder)
    assert listed(spark, folder) == ["", "/2025-05-06"]
    assert listed(spark, folder, "2025-05-05T03:00:00") == ["", "/2025-05-05", "/2025-05-06", "/2025-05-06/sub"]
    assert len(os.listdir(f"{folder}/listing")) == 2


def test_runs_by_changed_folders(spark, folder):
    root, options = f"{folder}/out", RunOptions(discovery="folders")
    deposit(folder, "a/1.parquet", [record(1, 20, "a")])
    deposit(folder, "b/1.parquet", [record(2, 20, "b")])
    settle(folder)
    assert run_incremental(spark, f"{folder}/raw", root, options, now=NOW)["files_processed"] == 2
    assert run_incremental(spark, f"{folder}/raw", root, options, now=NOW)["files_processed"] == 0
    deposit(folder, "aside.parquet", [record(1, 21, "new")])
    os.replace(f"{folder}/raw/aside.parquet", f"{folder}/raw/a/1.parquet")
    os.utime(f"{folder}/raw/a/1.parquet", (2_000_000_000, 2_000_000_000))
    assert run_incremental(spark, f"{folder}/raw", root, options, now=NOW)["files_processed"] == 1
    assert names(spark, root) == {1: "new", 2: "b"}


# --- replays



def test_replay_takes_its_place_and_is_applied_once(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "00.parquet", [record("0.0", 20, "zero"), record("9", 20, "nine")])
    run_incremental(spark, f"{folder}/raw", root, RunOptions(checkpoint_every=1), run_id="007", now=NOW)
    zero = lambda df: df.withColumn("id", F.regexp_replace("id", "0[.]0", "0"))
    assert replay.replay_quarantine(spark, root, zero, run_id="008", now=NOW)["records_processed"] == 1
    age(root, 9)
    assert "state/files/run_id=007" not in expire(spark, root, 1)
    assert replay.quarantined(spark, root).isEmpty() and names(spark, root) == {0: "zero", 9: "nine"}
    root = f"{folder}/second"
    os.remove(f"{folder}/raw/00.parquet")
    rows = [record("1.0", 20, "one"), record("2", 20, "two"), record("2.0", 21, "newer"), record("3.0", 20, "x" * 300), record("4.0", 20, "four")]
    deposit(folder, "0.parquet", rows)
    run_incremental(spark, f"{folder}/raw", root, run_id="r0", now=NOW)
    deposit(folder, "1.parquet", [record("4", 1, "later")])
    run_incremental(spark, f"{folder}/raw", root, run_id="r1", now=NOW)
    assert names(spark, root) == {2: "two", 4: "later"}
    mend = lambda df: df.withColumn("id", F.regexp_replace("id", "[.]0$", ""))
    nothing = replay.replay_quarantine(spark, root, run_id="none", now=NOW)
    assert (nothing["records_processed"], nothing["records_failed"]) == (0, 4)
    first = replay.replay_quarantine(spark, root, mend, run_id="p0", now=NOW)
    assert (first["records_processed"], first["records_failed"]) == (2, 1)
    # 4 was overwritten by a later run; 3 is too long; 2 is newer in the same file; batch ids are those of the arrival.
    assert names(spark, root) == {1: "one", 2: "newer", 4: "later"}
    assert {r["_etl_batch_id"] for r in read_target(spark, root).where("id < 3").collect()} == {"r0"}
    again = replay.replay_quarantine(spark, root, mend, run_id="p1", now=NOW)
    assert (again["records_processed"], again["records_failed"]) == (0, 1)
    last = replay.replay_quarantine(spark, root, mend, limits={"name": 400}, run_id="p2", now=NOW)
    assert (last["records_processed"], last["records_failed"]) == (1, 0)
    assert len(names(spark, root)[3]) == 300 and replay.quarantined(spark, root).isEmpty()
    assert run_incremental(spark, f"{folder}/raw", root)["files_processed"] == 0


def test_replay_of_partial_rows_and_where_dates_decide(spark, folder):
    root, options = f"{folder}/out", RunOptions(conflict="latest")
    deposit(folder, "0.parquet", [record("1", 20, "a"), record("2", 25, "b")])
    run_incremental(spark, f"{folder}/raw", root, options, run_id="r0", now=NOW)
    part = [{"id": "1.0", "updated_at": "2025-05-22T10:00:00", "payload": "new"}, {"id": "2.0", "updated_at": "2025-05-22T10:00:00", "payload": "old"}]
    deposit(folder, "1.parquet", part)
    run_incremental(spark, f"{folder}/raw", root, options, run_id="r1", now=NOW)
    mend = lambda df: df.withColumn("id", F.regexp_replace("id", "[.]0$", ""))
    replay.replay_quarantine(spark, root, mend, run_id="p", now=NOW)
    found = {r["id"]: (r["name"], r["payload"]) for r in read_target(spark, root).collect()}
    assert found == {1: ("a", "new"), 2: ("b", "p")}
    assert replay.replay_quarantine(spark, f"{folder}/nothing")["records_processed"] == 0


# --- errors of storage


@pytest.mark.parametrize("error, path", [
    (OSError("cannot open '/x/footer/a.parquet': Input/output error"), "/x/footer/a.parquet"),
    (PermissionError("magic"), "/x/a.parquet"), (TimeoutError("corrupt"), "/x/a.parquet"), (ConnectionError("thrift"), "/x/a.parquet"),
])
def test_storage_errors_are_told_by_class_not_by_path(monkeypatch, error, path):
    from pyarrow import fs

    def refused(self, path):
        raise error

    check = parquet._footer_check(["id"], ["id"])
    monkeypatch.setattr(fs, "LocalFileSystem", type("Refused", (), {"get_file_info": refused}))
    with pytest.raises(type(error)):
        list(check(iter([pd.DataFrame({"path": [path]})])))


def test_internal_names_may_be_columns(spark):
    from tidemark.operators.dedup import dedup_latest
    from tidemark.operators.upsert import merge_rows

    a = spark.createDataFrame([(1, 2, "x", 5)], "id int, updated_at int, _in_target string, _rank int")
    assert dedup_latest(a).first().asDict() == {"id": 1, "updated_at": 2, "_in_target": "x", "_rank": 5}
    assert merge_rows(a, a.withColumn("_in_target", F.lit("y"))).first()["_in_target"] == "y"


