"""Parquet reading: positions of rows, footers of files, and reads grouped by schema."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import glob_literal, plain_path
from tidemark.schema import KEY, PATH, RAW_SCHEMA, ROW, SEQ
from tidemark.session import qualify, settings

# Times cross to Python as microseconds, so no session zone is involved.
_CHECKED = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modified_micros", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField(SEQ, T.LongType()),
        T.StructField("signature", T.StringType()),
        # Columns beyond the expected ones, in the same form; an empty type is one Spark cannot cast from.
        T.StructField("others", T.StringType()),
        T.StructField("num_rows", T.LongType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)

NANOS = "timestamp_ns"


def read_parquet(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    positions: bool = True,
    skip_damaged: bool = False,
) -> DataFrame:
    """Parquet files, optionally with ``_path`` and ``_row`` (position within the file).

    A list of paths is taken literally; a single string may be a folder or a pattern.
    ``skip_damaged`` reads what it can of a broken file; the caller must then compare
    row counts with the footers.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if skip_damaged:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    if isinstance(paths, str):
        df = reader.parquet(paths)
    else:
        # Long path lists are looked up by a job that would have a task per path.
        lookups = max(
            int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
        )
        with settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(lookups)}):
            df = reader.parquet(*[glob_literal(p) for p in paths])
    if not positions:
        return df
    return df.select(
        "*",
        plain_path(F.col("_metadata.file_path")).alias(PATH),
        F.col("_metadata.row_index").alias(ROW),
    )


def file_locator():
    """The function tasks find a file with; made inside another, so it travels with the task like that one."""

    def locate(path: str):
        """A pyarrow filesystem and path for a path as Spark's listing spells it."""
        from pyarrow import fs

        if path.startswith("file:"):
            return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
        if path.startswith(("s3a://", "s3n://")):
            path = "s3://" + path.split("://", 1)[1]
        if "://" not in path:
            return fs.LocalFileSystem(), path
        scheme, rest = path.split("://", 1)
        root, _, inner = rest.partition("/")
        filesystem, base = fs.FileSystem.from_uri(f"{scheme}://{root}")
        return filesystem, f"{base.strip('/')}/{inner}"

    return locate


def _footer_check(expected: Sequence[str], required: Sequence[str]):
    """The function tasks run over batches of listed files.

    Everything it needs is defined inside, so it travels with the task and executors
    need no copy of this package.
    """
    # Arrow type name to the type Spark reads it as.
    spark_types = {
        "int8": "tinyint",
        "int16": "smallint",
        "int32": "int",
        "int64": "bigint",
        "uint8": "smallint",
        "uint16": "int",
        "uint32": "bigint",
        "uint64": "decimal(20,0)",
        "float": "float",
        "double": "double",
        "bool": "boolean",
        "string": "string",
        "large_string": "string",
        "binary": "binary",
        "large_binary": "binary",
        "date32[day]": "date",
        "null": "int",
    }
    nanos, output = NANOS, _CHECKED.fieldNames()

    locate = file_locator()

    def spark_type(arrow_type) -> str:
        """Empty for a type no expected column can be cast from."""
        from pyarrow import types as pt

        if pt.is_dictionary(arrow_type):
            return spark_type(arrow_type.value_type)
        if pt.is_timestamp(arrow_type):
            if arrow_type.unit == "ns":
                return nanos
            return "timestamp" if arrow_type.tz else "timestamp_ntz"
        if pt.is_decimal128(arrow_type):
            return f"decimal({arrow_type.precision},{arrow_type.scale})"
        return spark_types.get(str(arrow_type), "")

    def footer(path: str) -> dict:
        """Signature and row count of one file, or why it cannot be used. Reads the footer only."""
        import pyarrow.parquet as pq

        inner = path
        try:
            filesystem, inner = locate(path)
            info = filesystem.get_file_info(inner)
            with filesystem.open_input_file(inner) as source:
                meta = pq.read_metadata(source)
            leaves = [meta.schema.column(i) for i in range(len(meta.schema))]
            # Arrow shows 96-bit times as nanoseconds; Spark reads them as instants.
            wide = {leaf.path for leaf in leaves if leaf.physical_type == "INT96"}
            fields = {
                f.name: "timestamp" if f.name in wide else spark_type(f.type)
                for f in meta.schema.to_arrow_schema()
            }
            found = {}
            for name in expected:
                same = [f for f in fields if f.lower() == name.lower()]
                if len(same) > 1:
                    raise ValueError(f"ambiguous columns {same}")
                if same and not fields[same[0]]:
                    raise ValueError(f"column {name} has a nested or unsupported type")
                if same:
                    found[name] = fields[same[0]]
            missing = [name for name in required if name not in found]
            if missing:
                raise ValueError(f"missing columns {missing}")
            known = {name.lower() for name in expected}
            others = {n: k for n, k in fields.items() if n.lower() not in known}
            return {
                "signature": json.dumps(found),
                "others": json.dumps(others) if others else None,
                "num_rows": meta.num_rows,
                "length": info.size,
                # Milliseconds, the precision file listings have.
                "modified_micros": info.mtime_ns // 1_000_000 * 1000 if info.mtime_ns else None,
            }
        except (FileNotFoundError, ValueError, NotImplementedError) as error:
            return {"error_type": type(error).__name__, "error_message": str(error)}
        except (PermissionError, TimeoutError, ConnectionError):
            raise
        except OSError as error:
            # A footer that does not decode is a damaged file. Whatever else storage says
            # (credentials, throttling, time-outs) is no fault of the file: the task fails
            # and Spark repeats it. What the message says of the path says nothing of the error.
            said = str(error).replace(path, "").replace(inner, "").replace(inner.lstrip("/"), "").lower()
            if not any(word in said for word in ("thrift", "corrupt", "magic", "footer")):
                raise
            return {"error_type": type(error).__name__, "error_message": str(error)}

    def row(listed: dict) -> dict:
        known = {k: v for k, v in listed.items() if not pd.isna(v)}
        return {**footer(listed["path"]), **known}

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor

        # Each footer is a wait for storage; a few at once hide it.
        with ThreadPoolExecutor(16) as pool:
            for batch in batches:
                rows = list(pool.map(row, batch.to_dict("records")))
                yield pd.DataFrame(rows, columns=output, dtype=object)

    return check


def read_footers(
    files: DataFrame,
    expected: T.StructType = RAW_SCHEMA,
    required: Sequence[str] = (KEY,),
    tasks: int | None = None,
) -> DataFrame:
    """Check each listed file by its footer: column types, row count, or the error.

    The listing is spread by path: adaptive execution makes one task of a short listing
    and one per megabyte of a long one (some thousand files, read sixteen at a time);
    ``tasks`` fixes their number. ``files`` may lack the time and length (an explicit
    list of paths), which are then taken from the file.
    """
    listed = files.select(
        "path",
        (
            F.unix_micros("modificationTime")
            if "modificationTime" in files.columns
            else F.lit(None).cast("bigint")
        ).alias("modified_micros"),
        (F.col("length") if "length" in files.columns else F.lit(None).cast("bigint")).alias("length"),
        (F.col(SEQ) if SEQ in files.columns else F.lit(0)).cast("bigint").alias(SEQ),
    )
    check = _footer_check(expected.fieldNames(), list(required))
    spread = listed.repartition(tasks) if tasks else listed.repartition("path")
    checked = spread.mapInPandas(check, _CHECKED)
    return checked.select(
        "path",
        F.timestamp_micros("modified_micros").alias("modificationTime"),
        *[c for c in _CHECKED.fieldNames() if c not in ("path", "modified_micros")],
    )


def signature_schema(signature: str) -> tuple[T.StructType, dict[str, str]]:
    """Read schema of a footer signature, and which of its columns hold nanosecond times."""
    types = json.loads(signature)
    units = {name: "ns" for name, kind in types.items() if kind == NANOS}
    ddl = ", ".join(f"`{n}` {'bigint' if k == NANOS else k}" for n, k in types.items())
    return T.StructType.fromDDL(ddl), units


def explicit_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The caller's own list as a listing; ``_seq`` keeps its order. A repeated path counts once, last."""
    folders: dict[str, str] = {}  # each is looked up once, whatever the number of its files

    def whole(path: str) -> str:
        folder, slash, name = path.rpartition("/")
        if not folder or not name:
            return qualify(spark, path)
        if folder not in folders:
            folders[folder] = qualify(spark, folder)
        return f"{folders[folder]}{slash}{name}"

    order = {whole(p): i for i, p in enumerate(paths)}
    listed = F.lit(sorted(order, key=order.get)).cast("array<string>")
    return spark.range(0, 1, 1, 1).select(F.posexplode(listed).alias(SEQ, "path")).select(
        "path", F.col(SEQ).cast("bigint").alias(SEQ)
    )
