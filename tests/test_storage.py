import json
import os
import subprocess
import sys
from datetime import datetime, timezone

import pytest
from pyspark import cloudpickle
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from tests.test_incremental import deposit, record
from tidemark.operators.upsert import merge_into_table
from tidemark.plans.incremental import read_target
from tidemark.schema import MARK_SCHEMA, TARGET_SCHEMA
from tidemark.sinks import jdbc
from tidemark.sinks.keyed import KeyedTable, create_table
from tidemark.sinks.processed import read_processed, write_processed
from tidemark.sources.listing import list_files, new_or_changed, newer_than_mark, only_parquet
from tidemark.sources.parquet import _footer_check, read_footers, read_parquet
from tidemark.state.deadletter import (
    failed_rows,
    failures_of,
    log_failure,
    read_failed_log,
    read_foreign_log,
    write_failed_log,
)
from tidemark.state.ledger import (
    append_row,
    from_json_text,
    latest_mark,
    read_mark_file,
    read_marks,
    starting_mark,
    to_json_text,
    write_mark,
)
from tidemark.streaming.available import run_available

UTC = timezone.utc


def listing(spark):
    rows = [
        (f"raw/2025-05-{d}/file{i}.parquet", datetime(2025, 5, d, 10), 1000 * i)
        for i, d in enumerate((20, 21, 22), 1)
    ]
    rows.append((".watermark/last_run.json", datetime(2025, 5, 22, 10), 100))
    return spark.createDataFrame(rows, "path string, modificationTime timestamp, length bigint")


def test_files_after_the_mark(spark):
    mark = {"last_successful_run": "2025-05-21T00:00:00Z", "last_processed_file": "", "records_processed": 0}
    names = sorted(r["path"][-13:] for r in newer_than_mark(listing(spark), mark).collect())
    assert names == ["file2.parquet", "file3.parquet"]
    both = {**mark, "last_processed_file": "raw/2025-05-21/file2.parquet"}
    assert [r["path"] for r in newer_than_mark(listing(spark), both).collect()] == ["raw/2025-05-22/file3.parquet"]
    exact = {"last_successful_run": datetime(2025, 5, 21, 10, tzinfo=UTC)}
    assert newer_than_mark(listing(spark), exact).count() == 1
    assert newer_than_mark(listing(spark), None).count() == 3


def test_listing_of_a_folder(spark, folder):
    for name in ("a.parquet", "sub/b.parquet", "c.txt", ".watermark/x.parquet", "_tmp/y.parquet"):
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "w") as f:
            f.write("x")
    files = list_files(spark, folder)
    assert sorted(r["path"].rsplit("/", 1)[1] for r in files.collect()) == ["a.parquet", "b.parquet", "c.txt"]
    assert only_parquet(files).count() == 2
    assert list_files(spark, folder, glob="*.txt").count() == 1
    assert list_files(spark, folder, start_after=f"file:{folder}/b").count() == 2
    assert list_files(spark, folder, modified_after="2099-01-01T00:00:00").count() == 0
    assert list_files(spark, f"{folder}/missing").count() == 0
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan[plan.index("ReadSchema"):]


def test_ledger_rule(spark):
    files = listing(spark)
    done = files.select(
        "path",
        F.when(F.col("path").contains("file1"), F.lit("2020-01-01").cast("timestamp")).otherwise(F.col("modificationTime")).alias("modificationTime"),
        F.when(F.col("path").contains("file2"), "failed").otherwise("ok").alias("status"),
    )
    got = sorted(r["path"][15:20] for r in new_or_changed(files, done).collect())
    assert got == ["file1", "file2"]


def test_marks(spark, folder):
    path = f"{folder}/marks"
    assert read_marks(spark, path).count() == 0
    assert latest_mark(read_marks(spark, path)).count() == 0
    append_row(spark, path, starting_mark(), MARK_SCHEMA)
    first = latest_mark(read_marks(spark, path)).first()
    assert (first["last_processed_file"], first["records_processed"]) == ("", 0)
    assert first["last_successful_run"].startswith("1970")
    write_mark(spark, path, "raw/2025-05-21/data.parquet", 987432, datetime(2025, 5, 21, tzinfo=UTC))
    write_mark(spark, path, "raw/a.parquet", 1, datetime(2025, 5, 20))
    with open(f"{path}/broken.json", "w") as f:
        f.write("{not json\n")
    row = latest_mark(read_marks(spark, path)).first()
    assert (row["last_processed_file"], row["records_processed"]) == ("raw/2025-05-21/data.parquet", 987432)
    assert len(row["watermark_id"]) == 36
    text = to_json_text(read_marks(spark, path))
    assert sorted(from_json_text(text, MARK_SCHEMA).collect()) == sorted(read_marks(spark, path).collect())
    assert starting_mark("now")["last_successful_run"] > "2025"
    with pytest.raises(ValueError):
        starting_mark("never")


def test_foreign_mark_file(spark, folder):
    path = f"{folder}/last_run.json"
    assert read_mark_file(spark, path) is None
    mark = {"last_successful_run": "2025-05-21T00:00:00Z", "last_processed_file": "raw/x", "records_processed": 987432}
    with open(path, "w") as f:
        json.dump(mark, f, indent=2)
    assert read_mark_file(spark, path) == {**mark, "watermark_id": None}
    with open(f"{folder}/bad.json", "w") as f:
        f.write("{nope")
    assert read_mark_file(spark, f"{folder}/bad.json") is None


def test_failed_log(spark, folder):
    path = f"{folder}/failed"
    assert read_failed_log(spark, path).count() == 0
    log_failure(spark, path, "raw/a/test.parquet", ValueError("m" * 2000), 100, datetime(2025, 5, 22, tzinfo=UTC))
    rows = spark.createDataFrame([("raw/a_test.parquet", "E", "x", None)], "path string, error_type string, error_message string, records bigint")
    write_failed_log(failed_rows(rows, "2025-05-23T00:00:00+00:00"), path)
    log = read_failed_log(spark, path)
    assert log.count() == 2
    one = failures_of(log, "raw/a/test.parquet").first()
    assert (one["error_type"], one["record_count"], len(one["error_message"])) == ("ValueError", 100, 1000)
    assert one["additional_context"]["exception_type"] == "ValueError"
    assert one["log_name"] == "raw_a_test.parquet.error"
    day = read_failed_log(spark, path, "2025-05-23")
    assert [r["record_count"] for r in day.collect()] == [0]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "failed_date" in plan[plan.index("PartitionFilters"):].split("]")[0]
    with open(f"{folder}/f.error", "w") as f:
        json.dump({"error_type": "E", "error_message": "m", "record_count": 3, "timestamp": "t", "original_filename": "f"}, f, indent=2)
    assert read_foreign_log(spark, f"{folder}/f.error").first()["record_count"] == 3


def test_processed_sink_is_repeatable(spark, folder):
    df = spark.range(3)
    for _ in range(2):
        path = write_processed(df, f"{folder}/processed", "2025-05-22", "r1")
    assert "processed" in path
    write_processed(df, f"{folder}/processed", "2025-05-23", "r2")
    assert read_processed(spark, f"{folder}/processed").count() == 6
    assert read_processed(spark, f"{folder}/processed", "2025-05-23").count() == 3


def test_positions_within_files(spark, folder):
    path = deposit(folder, "a b+[1].parquet", [record(i, 20) for i in range(5)])
    rows = read_parquet(spark, [path]).select("id", "_row", "_path").collect()
    assert all(r["id"] == r["_row"] for r in rows)
    assert {r["_path"] for r in rows} == {f"file:{path}"}
    listed = list_files(spark, f"{folder}/raw").first()["path"]
    assert listed == f"file:{path}"
    footer = read_footers(list_files(spark, f"{folder}/raw")).first()
    assert footer["num_rows"] == 5 and footer["error_type"] is None
    assert footer["modificationTime"] == list_files(spark, f"{folder}/raw").first()["modificationTime"]


def test_footer_task_needs_no_copy_of_the_package(folder):
    path = deposit(folder, "a.parquet", [record(1, 20)])
    with open(f"{folder}/task.pkl", "wb") as f:
        f.write(cloudpickle.dumps(_footer_check(["id", "name"], ["id"])))
    code = (
        "import pickle, pandas as pd; f = pickle.load(open('task.pkl', 'rb'));"
        f"print(next(f(iter([pd.DataFrame({{'path': ['{path}']}})])))['num_rows'][0])"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True)
    assert done.stdout.strip() == "1", done.stderr


def test_target_declaration(spark):
    create_table(spark, "declared_target")
    create_table(spark, "declared_target")
    kinds = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE declared_target").collect()}
    assert kinds["status"] == "varchar(50)" and kinds["id"] == "bigint"
    assert list(kinds) == TARGET_SCHEMA.fieldNames()
    updates = spark.range(1).select("id", F.lit("a").alias("name"))
    with pytest.raises(UnsupportedOperationException) as refused:  # plain parquet has no row-level operations
        merge_into_table(updates, "declared_target")
    assert refused.value.getCondition() == "UNSUPPORTED_FEATURE.TABLE_OPERATION"
    spark.sql("DROP TABLE declared_target")


def test_keyed_table_with_composite_key(spark, folder):
    schema = spark.createDataFrame([], "a bigint, b string, updated_at timestamp_ntz, v bigint").schema
    table = KeyedTable(spark, folder, schema, ["a", "b"])
    assert table.read(None, [], None).count() == 0

    def rows(*values):
        return spark.createDataFrame([(a, b, datetime(2025, 5, d), v) for a, b, d, v in values], schema)

    one = table.write_changes(rows((1, "x", 1, 1), (1, "y", 1, 2)), "1")
    base = table.rewrite(None, [one], 3, "1")
    two = table.write_changes(rows((1, "x", 2, 3), (2, "x", 1, 4)), "2")
    three = table.write_changes(rows((2, "x", 1, 5)), "3")
    want = {(1, "x"): 3, (1, "y"): 2, (2, "x"): 5}
    for current in (
        table.read(None, [one, two, three], None),
        table.read(base, [two, three], 3),
        table.read(table.rewrite(base, [two, three], 3, "2"), [], 3),
    ):
        assert {(r["a"], r["b"]): r["v"] for r in current.collect()} == want


def test_stream_takes_new_paths_once(spark, folder):
    root = f"{folder}/out"
    deposit(folder, "1.parquet", [record(1, 20, "a")])
    deposit(folder, "sub/2.parquet", [record(2, 20, "b")])
    assert sum(t["files_processed"] for t in run_available(spark, f"{folder}/raw", root)) == 2
    assert run_available(spark, f"{folder}/raw", root) == []
    deposit(folder, "3.parquet", [record(1, 21, "c")])
    assert sum(t["files_processed"] for t in run_available(spark, f"{folder}/raw", root)) == 1
    assert {r["id"]: r["name"] for r in read_target(spark, root).collect()} == {1: "c", 2: "b"}


def test_relational_statements():
    merge = jdbc.merge_sql("records", "records_staging", ["name", "id", "status"])
    assert merge == (
        'MERGE INTO "records" AS t USING (SELECT DISTINCT "id", "name", "status" FROM "records_staging") AS s '
        'ON t."id" = s."id" WHEN MATCHED THEN UPDATE SET "name" = s."name", "status" = s."status" '
        'WHEN NOT MATCHED THEN INSERT ("id", "name", "status") VALUES (s."id", s."name", s."status")'
    )
    assert "UPDATE" not in jdbc.merge_sql("r", "s", ["id"])
    ddl = jdbc.create_table_sql("records")
    assert '"id" BIGINT PRIMARY KEY' in ddl and '"status" VARCHAR(50)' in ddl
    assert jdbc._quoted('a"b') == '"a""b"'
