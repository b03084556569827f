"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
#: It is exactly what ``bytes.split()`` splits on.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder under ``spark.checkpoint.dir`` and read back.

    It cuts the lineage: a lost executor costs its running tasks, not the steps before.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a like one that no column of ``df`` has."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def fold(key: Column, parts: int) -> Column:
    """Remainder of the CRC-32 of the key written as text; a null key is remainder 0 of the empty text."""
    return (F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts).cast("int")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


_BYTES = range(256)
#: A-Z in lower case, for ``bytes.translate``.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in _BYTES)
#: 1 for bytes of words, 0 for white space.
IN_WORD = bytes(b not in b" \t\n\v\f\r" for b in _BYTES)


def words_of(texts: pa.Array, inside: bytes = IN_WORD) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch of texts, A-Z in lower case, as bytes, and the row each is in. ``inside`` has 1 for each
    byte that words consist of; null texts have none."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if ends[0] == ends[-1]:
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    raw = texts.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes().translate(LOWER)
    data = np.frombuffer(raw, np.uint8)
    held = np.frombuffer(raw.translate(inside), bool)
    ends = ends - ends[0]
    begins = held.copy()
    begins[1:] &= ~held[:-1]
    first = ends[:-1][ends[:-1] < ends[1:]]
    begins[first] = held[first]  # a word never goes on from one text into the next
    closes = held.copy()
    closes[:-1] &= begins[1:] | ~held[1:]
    at = np.flatnonzero(begins)
    offsets = np.concatenate([[0], np.cumsum(np.flatnonzero(closes) - at + 1)])
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[held])]
    words = pa.Array.from_buffers(pa.large_binary(), len(at), buffers)
    return words, np.searchsorted(ends, at, "right") - 1


def numbered_values(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the distinct values of a column, and these values."""
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def most_frequent(df: DataFrame, count: str, most: int) -> DataFrame:
    """The ``most`` rows with the largest counts: all above a level of the count that is found first, and of the next
    level the first by count and the other columns.

    Levels are sixty-fourths of a logarithmic unit, so their table is small whatever the input, and no
    task has to hand over more rows than there are in the end.
    """
    level = F.floor(F.log(F.col(count)) * 64)
    sizes = sorted(df.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    least, total = None, 0
    for row in sizes:
        if total + row["n"] > most:
            break
        total += row["n"]
        least = row["level"]
    above = level >= least if least is not None else F.lit(False)
    rest = [row["level"] for row in sizes if least is None or row["level"] < least]
    if not rest or total == most:
        return df.where(above)
    # Of the level that does not fit, what still fits: by count, then by the other columns.
    others = [c for c in df.columns if c != count]
    next_ = df.where(level == rest[0]).orderBy(F.col(count).desc(), *others).limit(most - total)
    return df.where(above).unionByName(next_)


#: Bytes of one Arrow batch where the session names no bound: rows are long texts, and 10,000 of them may be too many.
BATCH_BYTES = 8 << 20
_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes, unless the bound it has is as low."""
    now = spark.conf.get(_BOUND).rstrip("b")
    if now.isdigit() and int(now) > BATCH_BYTES:
        spark.conf.set(_BOUND, str(BATCH_BYTES))


#: What modules keep in a Python worker between tasks, and how they let go of it. Workers are used again by other operators.
_KEPT: dict[str, Callable[[], None]] = {}


def keeps(module: str, clear: Callable[[], None]) -> None:
    """Let the first batch that a worker gets from another module's operator free what ``module`` has kept."""
    _KEPT[module] = clear


def per_batch(df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``mapInArrow`` for a function from one batch to columns by name; empty results are skipped.

    Batches are bounded by bytes, so memory depends on the longest text, not on the number of rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for module, clear in _KEPT.items():
            if module != work.__module__:
                clear()
        for batch in batches:
            if batch.num_rows:
                columns = work(batch)
                made = pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type, from_pandas=True) for f in out], schema=out
                )
                if made.num_rows:
                    yield made

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


#: A key with more than one row in ``HOT`` is hot: there are fewer than ``HOT`` such keys, whatever the input.
HOT = 1_000
_SALTS = 4_096


def looked_up(rows: DataFrame, keys: Sequence[str], found: DataFrame, size: str) -> DataFrame:
    """``rows`` with the other columns of ``found`` for their keys (null for a key it lacks; null keys are equal).

    ``found`` has one row per key, and in ``size`` how many of ``rows`` have it. The rows of hot keys, fewer than
    ``HOT``, are sent to every task; all other rows meet theirs by hash, and rows already answered are dealt evenly.
    """
    values = [c for c in found.columns if c not in keys and c != size]
    total = found.agg(F.sum(F.col(size).cast("decimal(38,0)")).alias("n")).first()["n"] or 0
    hot = F.coalesce(F.col(size), F.lit(0)).cast("decimal(38,0)") * HOT > F.lit(total)
    names = [f"_looked_{i}" for i in range(len(keys))]

    def side(part: DataFrame, answer: str) -> DataFrame:
        return part.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.struct(*values).alias(answer))

    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    first = rows.join(F.broadcast(side(found.where(hot), "_hot")), same, "left").drop(*names)
    dealt = F.monotonically_increasing_id() % _SALTS + 1
    first = first.withColumn("_salt", F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(dealt).cast("int"))
    rest = side(found.where(~hot), "_rest").withColumn("_none", F.lit(0))
    if rest.isEmpty():
        return first.select(*rows.columns, *[F.col("_hot").getField(v).alias(v) for v in values])
    both = first.join(rest, [*same, F.col("_salt") == F.col("_none")], "left")
    answer = F.coalesce("_hot", "_rest")
    return both.select(*rows.columns, *[answer.getField(v).alias(v) for v in values])
