"""Relational target: bulk copy into a staging table, then one set-based MERGE."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.audit import key_first
from tidemark.schema import KEY, VARCHAR_LIMITS

# Fixed value: rows per JDBC batch.
ROWS_PER_BATCH = 1000


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def create_table_sql(table: str) -> str:
    """DDL of the target, with its primary key and length limits."""
    # Column types of the target.
    types = {
        "id": "BIGINT PRIMARY KEY",
        "name": f"VARCHAR({VARCHAR_LIMITS['name']})",
        "email": f"VARCHAR({VARCHAR_LIMITS['email']})",
        "status": f"VARCHAR({VARCHAR_LIMITS['status']})",
        "updated_at": "TIMESTAMP",
        "payload": "TEXT",
        "_etl_processed_at": "TIMESTAMP",
        "_etl_batch_id": f"VARCHAR({VARCHAR_LIMITS['_etl_batch_id']})",
    }
    columns = ", ".join(f"{_quoted(c)} {t}" for c, t in types.items())
    return f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({columns})"


def merge_sql(table: str, staging: str, columns: Sequence[str], key: str = KEY) -> str:
    """Insert new keys, overwrite the supplied columns of known ones.

    Names are quoted because the JDBC writer quotes the ones it creates. The staged
    rows pass a DISTINCT: a task that ran twice leaves equal rows, never different ones.
    """
    others = [c for c in columns if c != key]
    listed = [key, *others]
    update = ", ".join(f"{_quoted(c)} = s.{_quoted(c)}" for c in others)
    matched = f"WHEN MATCHED THEN UPDATE SET {update} " if others else ""
    source = f"SELECT DISTINCT {', '.join(map(_quoted, listed))} FROM {_quoted(staging)}"
    return (
        f"MERGE INTO {_quoted(table)} AS t USING ({source}) AS s "
        f"ON t.{_quoted(key)} = s.{_quoted(key)} "
        f"{matched}"
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(map(_quoted, listed))}) "
        f"VALUES ({', '.join('s.' + _quoted(c) for c in listed)})"
    )


def execute(spark: SparkSession, url: str, properties: Mapping[str, str], statement: str) -> None:
    """Run one statement over a driver-side connection; no data passes through it."""
    jvm = spark.sparkContext._jvm
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    settings = jvm.java.util.Properties()
    for key, value in properties.items():
        settings.setProperty(key, str(value))
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        handle = connection.createStatement()
        handle.execute(statement)
        handle.close()
    finally:
        connection.close()


def upsert_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    key: str = KEY,
    connections: int = 8,
) -> None:
    """Upsert ``df`` (one row per key) into ``table``.

    Executors fill the staging table over a bounded number of connections. The MERGE is
    one statement, so the target changes as a whole or not at all.
    """
    staging = f"{table}_staging"
    writer = key_first(df, key).repartition(connections, key).write
    writer.format("jdbc").options(
        **{k: str(v) for k, v in properties.items()},
        url=url,
        dbtable=_quoted(staging),
        batchsize=ROWS_PER_BATCH,
    ).mode("overwrite").save()
    execute(df.sparkSession, url, properties, merge_sql(table, staging, df.columns, key))
