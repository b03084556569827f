"""Near-duplicate vectors by an epsilon grid order join.

For unit vectors, cosine >= t means distance <= sqrt(2 - 2t) = e. The leading principal dimensions of the vectors are
cut into cells of width e; vectors within e are at most one cell apart in each. Vectors are sorted by label and cells
(range partitions, no group in one task), cut into blocks of consecutive vectors, and blocks meet only if their cell
boxes come within one cell of each other. A pair of blocks is joined by halving the longer sequence again and again,
skipping provably distant intervals, until small intervals are compared exactly in double precision.

Equal vectors of one label are one node with a count, so exact copies never meet each other; a pair of blocks returns link
counts per node and a spanning forest of its links, never the pairs. Vectors link only when their labels are
equal and not null and their lengths agree; null or zero vectors and those with null or non-finite components link with
nothing. A repeated row is a vector of its own. A null id takes no part in the choice of the smallest id; its row is
not kept unless it links with nothing known. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_batch, stored
from tidemark.llm.components import components
from tidemark.llm.simhash import forest

BLOCK = 512
LEAF = 64
#: Leading principal dimensions that have cells.
CELLS = 4
#: Widens cells against rounding; the exact comparison decides.
SLACK = 1e-6


def axes(nodes: DataFrame, width: int) -> np.ndarray:
    """The leading principal dimensions of the unit vectors with ``width`` components (at most CELLS)."""

    def work(batches):
        total, n = np.zeros((width + 1, width)), 0
        for batch in batches:
            x = _matrix(batch.column(0), width)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            total[:width] += x.T @ x
            total[width] += x.sum(axis=0)
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n % 16], pa.int32()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                ["slot", "n", "sums"],
            )

    def add(key, group):
        sums = sum(np.frombuffer(b, np.float64) for b in group.column("sums").to_pylist())
        return pa.table({"slot": pa.array([0], pa.int32()), "n": [sum(group.column("n").to_pylist())], "sums": [sums.tobytes()]})

    schema = "slot int, n long, sums binary"
    own = nodes.where(F.size("vector") == width).select("vector")
    parts = own.mapInArrow(work, schema).groupBy("slot").applyInArrow(add, schema).collect()
    total = sum(np.frombuffer(r["sums"], np.float64) for r in parts).reshape(width + 1, width)
    n = sum(r["n"] for r in parts)
    mean = total[width] / n
    _, vectors = np.linalg.eigh(total[:width] / n - np.outer(mean, mean))
    return np.ascontiguousarray(vectors[:, ::-1][:, :CELLS])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, width)


def _apart(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two intervals of cells are more than one cell apart in some dimension."""
    return bool(((a.min(axis=0) > b.max(axis=0) + 1) | (b.min(axis=0) > a.max(axis=0) + 1)).any())


def _join(a: slice, b: slice, cells, unit, least: float, near: np.ndarray) -> None:
    """Mark the linked pairs of two intervals of one sequence in ``near``; ``a`` lies at or before ``b``."""
    if _apart(cells[a], cells[b]):
        return
    n, m = a.stop - a.start, b.stop - b.start
    if n <= LEAF and m <= LEAF:
        dots = unit.vectors[a] @ unit.vectors[b].T
        near[a, b] = dots / (unit.norms[a][:, None] * unit.norms[b][None, :]) >= least
    elif a == b:
        half = a.start + n // 2
        low, high = slice(a.start, half), slice(half, a.stop)
        for x, y in ((low, low), (low, high), (high, high)):
            _join(x, y, cells, unit, least, near)
    elif n >= m:
        half = a.start + n // 2
        _join(slice(a.start, half), b, cells, unit, least, near)
        _join(slice(half, a.stop), b, cells, unit, least, near)
    else:
        half = b.start + m // 2
        _join(a, slice(b.start, half), cells, unit, least, near)
        _join(a, slice(half, b.stop), cells, unit, least, near)


class _Sequence:
    def __init__(self, vectors: np.ndarray):
        self.vectors, self.norms = vectors, np.linalg.norm(vectors, axis=1)


def pair_links(blocks: list[dict], width: int, least: float):
    """Link counts and forest of one pair of blocks (or one block with itself).

    Returns (nodes, linked vectors of each node, forest edges); a block pair counts only links across.
    """
    nodes = np.concatenate([np.frombuffer(b["nodes"], np.int64) for b in blocks])
    times = np.concatenate([np.frombuffer(b["times"], np.int64) for b in blocks])
    cells = np.concatenate([np.frombuffer(b["cells"], np.int64).reshape(-1, CELLS) for b in blocks])
    unit = _Sequence(np.concatenate([np.frombuffer(b["vectors"], np.float64).reshape(-1, width) for b in blocks]))
    near = np.zeros((len(nodes), len(nodes)), bool)
    if len(blocks) == 1:
        _join(slice(0, len(nodes)), slice(0, len(nodes)), cells, unit, least, near)
        near = np.triu(near, 1)
    else:
        cut = len(blocks[0]["nodes"]) // 8
        _join(slice(0, cut), slice(cut, len(nodes)), cells, unit, least, near)
    near = near | near.T
    linked = near @ times.astype(np.float64)
    edges = [(int(nodes[p]), int(nodes[c])) for p, c in forest(near)]
    return nodes, linked.astype(np.int64), edges


def near_vectors(
    rows: DataFrame, least: float = 0.98, vector: str = "embedding", label: str = "label", key: str = "vec_id"
) -> DataFrame:
    """key, n_links, component_id, kept of every row."""
    rows = rows.select(F.col(key), F.col(label).alias("label"), F.col(vector).alias("vector"))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sound = (
        F.col("label").isNotNull()
        & F.coalesce(F.size("vector") > 0, F.lit(False))
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    sound = F.coalesce(sound & (norm > 0), F.lit(False))
    copies = rows.where(sound).groupBy("label", "vector").agg(F.count(F.lit(1)).alias("times"), F.min(key).alias("least"))
    nodes = stored(copies.withColumn("node", F.monotonically_increasing_id()), "vectors")
    epsilon = math.sqrt(max(0.0, 2 - 2 * least)) + SLACK
    widths = [r[0] for r in nodes.select(F.size("vector").alias("w")).distinct().collect()]
    found = None
    for width in widths:
        own = _links_of(nodes.where(F.size("vector") == width), width, axes(nodes, width), epsilon, least)
        found = own if found is None else found.union(own)
    plain = rows.select(key, F.lit(0).cast("long").alias("n_links"), F.col(key).cast("long").alias("component_id"))
    if found is None:
        return plain.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
    linked = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    reached = components(found.where("b is not null").select("a", "b"))
    grouped = (
        nodes.select("node", "times", "least")
        .join(linked, "node", "left")
        .join(reached, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    smallest = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    per_node = grouped.join(smallest, "component").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id"
    )
    per_vector = nodes.select("node", "label", "vector").join(per_node, "node").drop("node")
    out = rows.withColumn("label", F.when(sound, F.col("label"))).join(per_vector, ["label", "vector"], "left")
    return out.select(
        key,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", F.col(key)).cast("long").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.col("component_id").isNull()))


def _links_of(nodes: DataFrame, width: int, leading: np.ndarray, epsilon: float, least: float) -> DataFrame:
    """a, b, links: rows with b null carry a node's number of linked vectors, the others a forest edge."""
    names = [f"c{i}" for i in range(CELLS)]

    def place(batch: pa.RecordBatch) -> dict:
        x = _matrix(batch.column(3), width)
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        at = np.zeros((len(x), CELLS), np.int64)
        at[:, : leading.shape[1]] = np.floor(x @ leading / epsilon)
        return {
            "label": batch.column(0), "node": batch.column(1), "times": batch.column(2), "vector": batch.column(3),
            **{n: at[:, i] for i, n in enumerate(names)},
        }

    label_kind = nodes.schema["label"].dataType.simpleString()
    vector_kind = nodes.schema["vector"].dataType.simpleString()
    placed = per_batch(
        nodes.select("label", "node", "times", "vector"),
        place,
        f"label {label_kind}, node long, times long, vector {vector_kind}, " + ", ".join(f"{n} long" for n in names),
    )
    order = ["label", *names, "node"]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def blocks(batch: pa.RecordBatch) -> dict:
        labels = batch.column(0).to_pylist()
        nodes_, times = (np.asarray(batch.column(i), np.int64) for i in (1, 2))
        x = _matrix(batch.column(3), width)
        at = np.stack([np.asarray(batch.column(4 + i), np.int64) for i in range(CELLS)], axis=1)
        out: dict[str, list] = {k: [] for k in ("block", "label", "low", "high", "nodes", "times", "cells", "vectors")}
        start = 0
        for i in range(1, len(labels) + 1):
            if i == len(labels) or labels[i] != labels[start] or i - start == BLOCK:
                s = slice(start, i)
                out["block"].append(int(nodes_[start]))  # a node is in one block, so its number names it
                out["label"].append(labels[start])
                out["low"].append(at[s].min(axis=0).tolist())
                out["high"].append(at[s].max(axis=0).tolist())
                for k, v in (("nodes", nodes_), ("times", times), ("cells", at), ("vectors", x)):
                    out[k].append(np.ascontiguousarray(v[s]).tobytes())
                start = i
        return out

    made = stored(
        per_batch(
            ordered,
            blocks,
            f"block long, label {label_kind}, low array<long>, high array<long>, nodes binary, times binary, cells binary, vectors binary",
        ),
        "blocks",
    )
    summary = made.select("block", "label", "low", "high")

    def dealt(reach: int) -> DataFrame:
        by_two = summary.withColumn("x", F.explode(F.sequence(F.col("low")[0], F.col("high")[0] + reach)))
        return by_two.withColumn("y", F.explode(F.sequence(F.col("low")[1] - reach, F.col("high")[1] + reach)))

    a, b = dealt(1).alias("a"), dealt(0).alias("b")
    close = " and ".join(f"a.low[{i}] <= b.high[{i}] + 1 and b.low[{i}] <= a.high[{i}] + 1" for i in range(CELLS))
    pairs = a.join(b, ["label", "x", "y"]).where(close)
    pairs = pairs.select(F.least("a.block", "b.block").alias("i"), F.greatest("a.block", "b.block").alias("j")).distinct()
    data = made.select("block", F.struct("nodes", "times", "cells", "vectors").alias("own"))
    met = pairs.join(data.toDF("i", "left"), "i").join(data.toDF("j", "right"), "j")

    def work(batch: pa.RecordBatch) -> dict:
        a_, b_, n_ = [], [], []
        for i, j, x, y in zip(*[batch.column(c).to_pylist() for c in ("i", "j", "left", "right")]):
            nodes_, linked, edges = pair_links([x] if i == j else [x, y], width, least)
            hit = np.nonzero(linked)[0]
            a_ += [*nodes_[hit].tolist(), *[e[0] for e in edges]]
            b_ += [*[None] * len(hit), *[e[1] for e in edges]]
            n_ += [*linked[hit].tolist(), *[None] * len(edges)]
        return {"a": a_, "b": b_, "links": n_}

    return stored(per_batch(met, work, "a long, b long, links long"), "links")
