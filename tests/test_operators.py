"""Small fixtures for every operator, and brute-force comparisons for the stateful ones."""

import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions.convert import convert, iso_text
from tidemark.functions.text import failed_log_name, glob_literal, plain_path, short_message
from tidemark.operators.audit import add_audit_columns, key_first
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.metrics import TableStats, run_totals
from tidemark.operators.normalize import cast_failure_counts, fill_nulls, normalize
from tidemark.operators.slices import batch_number, batch_stats
from tidemark.operators.upsert import change_feed, fold_arrivals, merge_rows, upsert
from tidemark.operators.validate import (
    ErrorRateExceeded,
    check_rows,
    enforce_error_rate,
    error_rate,
    key_violations,
    split_quarantine,
)
from tidemark.plans.records import process_slices, process_table
from tidemark.schema import BATCH, ERRORS, PATH, RAW, ROW, SUPPLIED
from pyspark.sql import types as T


def day(n):
    return datetime(2025, 5, n, 10)


def test_latest_row_per_id(spark):
    rows = [(1, day(20), "a"), (1, day(21), "b"), (2, day(20), "c"), (2, day(21), "d"), (3, day(22), "e")]
    df = spark.createDataFrame(rows, "id bigint, updated_at timestamp_ntz, name string")
    assert sorted(r["name"] for r in dedup_latest(df).collect()) == ["b", "d", "e"]


def test_dedup_edges(spark):
    rows = [
        (1, None, "null beside date"), (1, day(20), "dated"),
        (2, None, "x1"), (2, None, "x2"),
        (None, day(20), "k1"), (None, day(21), "k2"),
        (4, day(20), "t1"), (4, day(20), "t2"),
    ]
    df = spark.createDataFrame(rows, "id bigint, updated_at timestamp_ntz, name string")
    last = {r["id"]: r["name"] for r in dedup_latest(df).collect()}
    assert last == {1: "dated", 2: "x2", None: "k2", 4: "t2"}
    first = {r["id"]: r["name"] for r in dedup_latest(df, nulls="first").collect()}
    assert first[1] == "null beside date" and first[2] == "x2"
    assert dedup_latest(df.limit(0)).count() == 0
    assert dedup_latest(df.select("id"), order=()).count() == 4
    with pytest.raises(ValueError):
        dedup_latest(df, nulls="middle")


def test_dedup_plan_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("id"), F.col("id").alias("updated_at"))
    plan = dedup_latest(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    before_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_normalize_types(spark):
    df = spark.createDataFrame(
        [(1, 2.5, True, "2025-05-20T10:00:00", "x")], "id int, name double, status boolean, updated_at string, extra string"
    )
    out = normalize(df)
    assert out.columns == df.columns
    assert [t for _, t in out.dtypes] == ["bigint", "string", "string", "timestamp_ntz", "string"]
    assert out.first() == (1, "2.5", "true", day(20), "x")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_date_texts_and_native_dates(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = {
            "2025-05-20T10:00:00": day(20),
            "2025-05-20T10:00:00.5": datetime(2025, 5, 20, 10, 0, 0, 500000),
            "2025-05-20T10:00:00.123456": datetime(2025, 5, 20, 10, 0, 0, 123456),
            "2025-05-20T10:00:00.123456789": datetime(2025, 5, 20, 10, 0, 0, 123456),
            "2025-05-20 10:00:00": None,
            "2025-05-20": None,
            "2025-05-20T10:00:00Z": None,
            "2025-13-40T10:00:00": None,
            "tomorrow": None,
            None: None,
        }
        df = spark.createDataFrame([(t,) for t in texts], "updated_at string")
        got = normalize(df.select(F.col("updated_at").alias("t"), "updated_at"))
        assert {r["t"]: r["updated_at"] for r in got.collect()} == texts

        instant = spark.range(1).select(F.timestamp_micros(F.lit(1747735200000000)).alias("updated_at"))
        assert normalize(instant).first()[0] == day(20)
        nanos = spark.range(1).select(F.lit(1747735200123456789).alias("updated_at"))
        assert normalize(nanos, units={"updated_at": "ns"}).first()[0] == datetime(2025, 5, 20, 10, 0, 0, 123456)
        early = spark.range(1).select(F.lit(-1).cast("bigint").alias("updated_at"))
        assert normalize(early, units={"updated_at": "ns"}).first()[0] == datetime(1969, 12, 31, 23, 59, 59, 999999)
        text = spark.range(1).select(iso_text(F.lit("2025-05-20 10:00:00.5").cast("timestamp_ntz")))
        assert text.first()[0] == "2025-05-20T10:00:00.500000"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_integer_texts(spark):
    texts = {
        "12": 12, " 12 ": 12, "-7": -7, "+7": 7, "0000000000000000000000012": 12, "1.5": None, "": None,
        "abc": None, "9223372036854775807": 2**63 - 1, "9223372036854775808": None, "99999999999999999999": None,
        "1e3": None, None: None,
    }
    df = spark.createDataFrame([(t, t) for t in texts], "t string, id string")
    assert {r["t"]: r["id"] for r in normalize(df).collect()} == texts
    # the shape test in front changes no result
    plain = df.select("t", F.col("id").try_cast("bigint").alias("id"))
    assert {r["t"]: r["id"] for r in plain.collect()} == texts


def test_keep_column_policy(spark, caplog):
    df = spark.createDataFrame([("1", "5"), ("x", "6")], "id string, name string")
    out = normalize(df.withColumn("payload", F.lit(3)), on_error="keep_column")
    assert dict(out.dtypes) == {"id": "string", "name": "string", "payload": "string"}
    assert "column id left uncast" in caplog.text
    assert cast_failure_counts(df).first() == (1, 0)
    with pytest.raises(ValueError):
        normalize(df, on_error="explode")


def test_unconvertible_types_are_rejected_values(spark):
    df = spark.sql("SELECT timestamp_ntz'2025-05-20 10:00:00' AS id, true AS updated_at")
    row = normalize(df, on_error="quarantine").first()
    assert row["id"] is None and row["updated_at"] is None
    assert row[ERRORS] == ["cast:id", "cast:updated_at"]
    with pytest.raises(ValueError):
        convert(F.lit(1), T.LongType(), T.DateType())


def test_quarantine_keeps_the_raw_row(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "id string, name string")
    checked = check_rows(normalize(df, on_error="quarantine"))
    good, bad = split_quarantine(checked)
    assert [r["id"] for r in good.collect()] == [1]
    got = {r["name"]: (r[ERRORS], r[RAW]) for r in bad.collect()}
    assert got == {"b": (["cast:id"], '{"id":"x","name":"b"}'), "c": (["null:id"], None)}


def test_length_limits(spark):
    df = spark.createDataFrame(
        [(1, "n" * 255, "s" * 50), (2, "n" * 256, "s"), (3, "n", "s" * 51), (4, "\U0001d11e" * 255, "é" * 50)],
        "id bigint, name string, status string",
    )
    assert {r["id"]: r[ERRORS] for r in check_rows(df).collect()} == {
        1: [], 2: ["length:name"], 3: ["length:status"], 4: [],
    }
    assert check_rows(df.drop("id")).first()[ERRORS] == ["null:id"]


def test_key_violations_and_error_rate(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id bigint")
    assert {(r["id"], r["n"]) for r in key_violations(df).collect()} == {(1, 2), (None, 1)}
    row = error_rate(check_rows(df)).first()
    assert (row["rows_total"], row["rows_failed"], row["error_rate"], row["within_limit"]) == (4, 1, 0.25, False)
    assert error_rate(check_rows(df.limit(0))).first()["within_limit"]
    enforce_error_rate(10_000, 9, 0.001)
    enforce_error_rate(10, 9, None)
    with pytest.raises(ErrorRateExceeded):
        enforce_error_rate(10_000, 10, 0.001)


def test_fill_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, "a")], "id bigint, status string")
    assert fill_nulls(df, {"status": "unknown", "absent": 1}).collect() == [(1, "unknown"), (None, "a")]


def test_audit_columns_and_key_first(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    out = add_audit_columns(df, "test-batch-123", datetime(2025, 5, 22, 3, tzinfo=timezone.utc))
    assert [(r["_etl_batch_id"], r["_etl_processed_at"]) for r in out.collect()] == [
        ("test-batch-123", datetime(2025, 5, 22, 3))
    ] * 2
    drawn = add_audit_columns(df).select("_etl_batch_id", "_etl_processed_at").distinct().collect()
    assert len(drawn) == 1 and len(drawn[0][0]) == 36
    assert key_first(df.select("name", "id")).columns == ["id", "name"]


def test_batch_numbers_and_stats(spark):
    df = spark.range(7).select("id", batch_number(F.col("id"), 3).alias("b"))
    assert [r["b"] for r in df.orderBy("id").collect()] == [1, 1, 1, 2, 2, 2, 3]
    with pytest.raises(ValueError):
        batch_number(F.lit(1), 0)
    rows = spark.createDataFrame([("f", 1, 1), ("f", 1, 1), ("f", 1, None), ("f", 1, None), ("f", 2, 1)], f"{PATH} string, {BATCH} int, id bigint")
    got = {r[BATCH]: (r["input_rows"], r["output_rows"], r["duplicates_removed"]) for r in batch_stats(rows).collect()}
    assert got == {1: (4, 2, 2), 2: (1, 1, 0)}


def test_process_table_with_stats(spark):
    rows = [(1, "2025-05-20T10:00:00", "a"), (1, "2025-05-21T10:00:00", "b"), (2, "2025-05-20T10:00:00", "c")]
    df = spark.createDataFrame(rows, "id bigint, updated_at string, name string")
    stats = TableStats("b-1")
    out = process_table(df, "b-1", day(22), stats=stats)
    assert sorted(r["name"] for r in out.collect()) == ["b", "c"]
    assert stats.result() == {"batch_id": "b-1", "input_rows": 3, "output_rows": 2, "duplicates_removed": 1}


def test_process_slices(spark):
    rows = [("f", 0, 1, "a"), ("f", 1, 1, "b"), ("f", 2, 1, "c"), ("g", 0, 1, "d")]
    df = spark.createDataFrame(rows, f"{PATH} string, {ROW} bigint, id bigint, name string").withColumn(
        "updated_at", F.lit("2025-05-20T10:00:00")
    )
    out = process_slices(df, 2, "run", day(22)).collect()
    assert {(r[PATH], r["name"], r["_etl_batch_id"]) for r in out} == {
        ("f", "b", "run_b1"), ("f", "c", "run_b2"), ("g", "d", "run_b1"),
    }


def test_run_totals_ignore_rows_of_failed_files(spark):
    df = spark.createDataFrame([("ok", 5, 1), ("failed", 7, 2)], "status string, records bigint, records_failed bigint")
    assert run_totals(df).first() == (1, 1, 5, 1)
    assert run_totals(df.limit(0)).first() == (0, 0, 0, 0)


TARGET = "id bigint, name string, updated_at timestamp_ntz, payload string"


def test_upsert_kinds(spark):
    target = spark.createDataFrame(
        [(1, "old", day(20), "p"), (2, "stay", day(20), "p"), (3, "newer", day(25), "p"), (4, "undated", None, "p")], TARGET
    )
    updates = spark.createDataFrame(
        [(1, "new", day(21), None), (3, "older", day(21), "q"), (4, "dated", day(1), "q"), (5, "ins", None, "q")], TARGET
    )
    arrival = {r["id"]: (r["name"], r["payload"]) for r in upsert(target, updates).collect()}
    assert arrival == {1: ("new", None), 2: ("stay", "p"), 3: ("older", "q"), 4: ("dated", "q"), 5: ("ins", "q")}
    general = {r["id"]: (r["name"], r["payload"]) for r in merge_rows(target, updates).collect()}
    assert general == arrival
    latest = {r["id"]: r["name"] for r in upsert(target, updates, conflict="latest").collect()}
    assert latest == {1: "new", 2: "stay", 3: "newer", 4: "dated", 5: "ins"}
    undated = spark.createDataFrame([(1, "undated", None, "p")], TARGET)
    assert {r["id"]: r["name"] for r in upsert(target, undated, conflict="latest").collect()}[1] == "old"
    twice = upsert(upsert(target, updates), updates)
    assert sorted(twice.collect(), key=repr) == sorted(upsert(target, updates).collect(), key=repr)


def test_upsert_partial_and_shuffled_columns(spark):
    target = spark.createDataFrame([(1, "old", day(20), "p")], TARGET)
    updates = spark.createDataFrame([(None, 1), ("ins", 2)], "name string, id bigint")
    got = upsert(target, updates)
    assert got.columns == target.columns
    assert sorted(got.collect()) == [(1, None, day(20), "p"), (2, "ins", None, None)]
    per_row = spark.createDataFrame(
        [(1, "x", "y", ["payload"]), (2, "x", "y", ["name"])], f"id bigint, name string, payload string, {SUPPLIED} array<string>"
    )
    assert sorted(upsert(target, per_row).collect()) == [(1, "old", day(20), "y"), (2, "x", None, None)]
    with pytest.raises(ValueError):
        upsert(target, updates.withColumn("unknown", F.lit(1)))
    with pytest.raises(ValueError):
        upsert(target, updates.drop("id"))
    with pytest.raises(ValueError):
        upsert(target, updates, conflict="never")


def test_change_feed(spark):
    target = spark.createDataFrame(
        [(1, "a", day(20), "p"), (2, "b", day(20), None), (3, "c", day(25), "p"), (4, "d", day(20), "p")], TARGET
    )
    updates = spark.createDataFrame(
        [(1, "A", day(20), "p"), (2, "b", day(20), None), (3, "C", day(21), "p"), (5, "e", day(20), "p")], TARGET
    )
    got = {r["id"]: (r["_change_type"], r["name"]) for r in change_feed(target, updates).collect()}
    assert got == {1: ("update", "A"), 2: ("unchanged", "b"), 3: ("stale", "C"), 5: ("insert", "e")}
    full = {r["id"]: r["_change_type"] for r in change_feed(target, updates, include_untouched=True).collect()}
    assert full == {1: "update", 2: "unchanged", 3: "stale", 4: "untouched", 5: "insert"}


def test_fold_equals_upserting_one_by_one(spark):
    """Random arrivals with random supplied columns, in many groups at once, against a loop."""
    rng = random.Random(7)
    rows, want = [], {}
    for group in range(60):
        for n in range(rng.randint(1, 12)):
            key = (group, rng.randint(1, 3))
            given = [c for c in ("a", "b") if rng.random() < 0.6]
            value = {c: rng.choice([None, rng.randint(0, 9)]) for c in ("a", "b")}
            rows.append((*key, n, value["a"], value["b"], ["g", "id", *given]))
            stored = want.setdefault(key, {"a": None, "b": None})
            stored.update({c: value[c] for c in given})
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, f"g bigint, id bigint, n bigint, a bigint, b bigint, {SUPPLIED} array<string>")
    got = {(r["g"], r["id"]): {"a": r["a"], "b": r["b"]} for r in fold_arrivals(df, ["g", "id"], ["n"], ["a", "b"]).collect()}
    assert got == want
    whole = {}
    for g, key, n, a, b, _ in sorted(rows, key=lambda r: r[2]):
        whole[(g, key)] = (a, b)
    folded = fold_arrivals(df.drop(SUPPLIED), ["g", "id"], ["n"], ["a", "b"]).collect()
    assert {(r["g"], r["id"]): (r["a"], r["b"]) for r in folded} == whole


def test_latest_mode_does_not_depend_on_arrival(spark):
    """Upserting shuffled rows one by one with ``latest`` ends where one fold by date does."""
    rng = random.Random(3)
    rows = [(rng.randint(1, 3), f"r{i}", day(i + 1), "p") for i in range(9)]
    state = spark.createDataFrame([], TARGET)
    order = rows[:]
    rng.shuffle(order)
    for i in range(0, len(order), 3):
        part = dedup_latest(spark.createDataFrame(order[i:i + 3], TARGET))
        state = upsert(state, part, conflict="latest")
    folded = fold_arrivals(spark.createDataFrame(rows, TARGET), arrival=["updated_at"]).select(state.columns)
    assert sorted(state.collect()) == sorted(folded.collect())


def test_text_helpers(spark):
    df = spark.createDataFrame([("a/b\\c.parquet",), ("x.error",)], "f string")
    assert [r[0] for r in df.select(failed_log_name(F.col("f"))).collect()] == ["a_b_c.parquet.error", "x.error"]
    lengths = spark.createDataFrame([("m" * 1000,), ("m" * 1001,)], "m string")
    assert [len(r[0]) for r in lengths.select(short_message(F.col("m"))).collect()] == [1000, 1000]
    assert glob_literal("a[1]{x}*?") == "a\\[1\\]\\{x\\}\\*\\?"
    uri = spark.createDataFrame([("file:/a%20b+c%5B1%5D",)], "u string")
    assert uri.select(plain_path(F.col("u"))).first()[0] == "file:/a b+c[1]"
