"""Product codes of vectors in whole numbers: exact nearest entries by limb-split matrix products.

Components become integers. A product of two integer matrices is taken in pieces: every integer is split into limbs so
narrow that a float64 matrix product of two limbs adds up below 2^53 and is exact; the pieces are put together in
64-bit integers. So every distance, and the first smallest one, is the same on every machine and in any order of rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import looked_up, per_batch, stored

#: Bits of a whole number that float64 holds exactly.
EXACT = 53


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """``values`` as float64 limbs, lowest first: values = sum of limb[i] * 2**(i * bits); the last one has the sign."""
    out, rest = [], values
    while rest.size and (int(rest.max()) >= 1 << bits or int(rest.min()) < -(1 << bits)):
        out.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    return [*out, rest.astype(np.float64)]


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, exact wherever the result fits 64 bits."""
    width = max(1, a.shape[1])
    bits = (EXACT - 1 - (width - 1).bit_length()) // 2
    out = np.zeros((len(a), len(b)), np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << ((i + j) * bits)
    return out


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First nearest entry of every point, and its squared distance."""
    half = (entries * entries).sum(axis=1)[None, :] - 2 * exact_products(points, entries)
    best = half.argmin(axis=1)
    return best, half[np.arange(len(points)), best] + (points * points).sum(axis=1)


def whole_numbers(column: pa.Array, scale: int) -> np.ndarray:
    """A matrix of floor(scale * x) from a list column whose lists are equally long and finite."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(flat * scale)
    width = len(flat) // len(column)
    # Squared distances, and sums of a vector's parts, must fit 64 bits.
    most = 1 << ((62 - max(1, width).bit_length()) // 2 - 1)
    if scaled.size and not np.abs(scaled).max() < most:
        raise ValueError(f"a component times {scale} is {most} or more: squared distances would not fit 64 bits")
    return scaled.astype(np.int64).reshape(len(column), width)


def _in_parts(matrix: np.ndarray, parts: int) -> np.ndarray:
    """Rows cut into equal parts, filled up with zeros, which add nothing to a distance."""
    missing = -matrix.shape[1] % parts
    return np.pad(matrix, ((0, 0), (0, missing))).reshape(len(matrix), parts, -1)


def sound_vectors(vectors: DataFrame, vector: str, width: int | None = None) -> DataFrame:
    """Rows whose vector holds finite numbers only (and has ``width`` of them)."""
    number = F.lit(True) if width is None else F.size(vector) == width
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vector).isNotNull() & number & ~F.coalesce(bad, F.lit(False)))


class Codebooks:
    """Entries of every part position: an int64 array (parts, entries, width of a part)."""

    def __init__(self, entries: np.ndarray, scale: int, length: int):
        self.entries, self.scale, self.length = entries, scale, length

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assigned(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Points by part, their entries, and the squared distances, each with one row per vector."""
        points = _in_parts(whole_numbers(column, self.scale), len(self.entries))
        found = [nearest(points[:, p], self.entries[p]) for p in range(len(self.entries))]
        return points, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)

    def moved(self, vectors: DataFrame, vector: str) -> Codebooks:
        """Every entry at the floor of its points' mean; entries without points stay.

        Tasks send one sum per entry and component and batch, so what is shuffled depends on the number of
        batches and the size of the codebooks; their sums, as many numbers as the codebooks have, reach the driver.
        """
        parts, size, width = self.entries.shape

        def sums(batch: pa.RecordBatch) -> dict:
            points, near, _ = self.assigned(batch.column(0))
            total = np.zeros((parts, size, width), np.int64)
            count = np.zeros((parts, size), np.int64)
            for p in range(parts):
                np.add.at(total[p], near[:, p], points[:, p])
                count[p] = np.bincount(near[:, p], minlength=size)
            used = np.repeat(count.ravel() > 0, width)
            return {
                "place": np.flatnonzero(used), "total": total.ravel()[used], "n": np.repeat(count.ravel(), width)[used]
            }

        found = per_batch(vectors.select(vector), sums, "place long, total long, n long")
        wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("total", "n")]
        entries = self.entries.ravel().copy()
        for row in found.groupBy("place").agg(*wide).collect():  # at most one row per number of the codebooks
            entries[row["place"]] = int(row["total"]) // int(row["n"])
        return Codebooks(entries.reshape(self.entries.shape), self.scale, self.length)


def first_codebooks(vectors: DataFrame, vector: str, key: str, parts: int, size: int, scale: int) -> Codebooks | None:
    """The parts of the vectors with the ``size`` smallest keys (null last, ties by components); None of no vectors.

    The first of them also says how long vectors are.
    """
    order = [F.col(key).asc_nulls_last(), F.col(vector).asc()]
    first = vectors.orderBy(*order).select(vector).first()
    if first is None:
        return None
    width = len(first[0])
    rows = sound_vectors(vectors, vector, width).orderBy(*order).select(vector).limit(size).collect()
    column = pa.array([r[0] for r in rows], pa.list_(pa.float64()))
    if not width:
        return Codebooks(np.zeros((parts, len(rows), 0), np.int64), scale, 0)
    return Codebooks(np.swapaxes(_in_parts(whole_numbers(column, scale), parts), 0, 1).copy(), scale, width)


def compressed(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    vector: str = "embedding",
    key: str = "vec_id",
    label: str = "label",
) -> DataFrame:
    """key, label, code, error, label_error, codebooks_sha256 of every sound vector.

    Components become floor(scale * x), vectors are cut into ``parts`` equal parts (filled up with zeros where their
    length is no multiple), and each part position has a codebook, refined in ``rounds`` rounds of assigning every
    part to its nearest entry (ties: the first) and moving every entry to the floor of its parts' mean.

    Vectors that are null or hold null or non-finite components are dropped, and so are those of another length than
    the vector with the smallest key. Null keys come last and null labels are one group; repeated rows each get a code;
    vectors without components have the error 0; fewer vectors than entries make smaller codebooks; an empty table gives an
    empty one; extra columns are ignored. Components so large that squared distances pass 64 bits are refused by an
    error. Every round reads the table and keeps nothing, so a lost executor costs its tasks.
    """
    if entries > 256:
        raise ValueError("an index has two hex digits: at most 256 entries")
    rows = vectors.select(F.col(key), F.col(label), F.col(vector).cast("array<double>").alias(vector))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    made = f"`{key}` {kinds[key]}, `{label}` {kinds[label]}, code string, error long"
    books = first_codebooks(sound_vectors(rows, vector), vector, key, parts, entries, scale)
    if books is None:
        return rows.sparkSession.createDataFrame([], f"{made}, label_error long, codebooks_sha256 string")
    length = books.length
    sound = sound_vectors(rows, vector, length)
    for _ in range(rounds if length else 0):
        books = books.moved(sound, vector)

    def code(batch: pa.RecordBatch) -> dict:
        n = batch.num_rows
        near, far = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
        if length:
            _, near, far = books.assigned(batch.column(2))
        return {
            key: batch.column(0), label: batch.column(1),
            "code": [bytes(row).hex() for row in near.astype(np.uint8)], "error": far.sum(axis=1),
        }

    coded = stored(per_batch(sound, code, made), "codes")
    totals = coded.groupBy(label).agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("members"))
    out = looked_up(coded, [label], stored(totals, "totals"), "members")
    return out.withColumn("codebooks_sha256", F.lit(books.sha256))
