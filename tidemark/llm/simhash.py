"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint's 64 bits are parted into ``bits + 3`` blocks. Fingerprints that differ in ``bits`` places or fewer
agree in at least three blocks, so joining on every choice of three blocks (about 32 bits) misses no pair; the
Hamming distance of what meets is then checked. Equal fingerprints are one node from the start, so a group of
exact copies, however large, never meets itself. A key with very many fingerprints is parted into chunks and met
chunk by chunk; each chunk pair sends a spanning forest of its links, never all pairs.

Nulls and texts without a word have fingerprint zero and link like any other. Null keys stay null and are the
component of nothing; a component of null keys only is null. Repeated rows are copies. Empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, per_batch
from tidemark.llm.components import components

#: Fingerprints of one key that are compared in one piece.
CHUNK = 2000
#: Shingles hashed and counted at a time, which bounds the memory of a very long text.
SLAB = 1 << 16


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint of a text, unsigned."""
    from xxhash import xxh64_digest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    total = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, total, SLAB):
        part = words[start : start + SLAB + shingle - 1]
        runs = map(b" ".join, zip(*[part[i:] for i in range(shingle)])) if len(words) >= shingle else [b" ".join(words)]
        digests = np.frombuffer(b"".join([xxh64_digest(run, seed) for run in runs]), np.uint8)
        ones += np.unpackbits(digests.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, fp: the fingerprint of each row as a signed long."""

    def work(batch: pa.RecordBatch) -> dict:
        made = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
        return {key: batch.column(0), "fp": np.array(made, np.uint64).view(np.int64)}

    kind = docs.schema[key].dataType.simpleString()
    return per_batch(docs.select(F.col(key), F.col(text)), work, f"{key} {kind}, fp long")


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges (parent, child) of a spanning forest of a symmetric adjacency matrix."""
    left, edges = np.ones(len(near), bool), []
    for root in range(len(near)):
        if not left[root]:
            continue
        left[root] = False
        level = [root]
        while level:
            ahead = []
            for node in level:
                found = np.nonzero(near[node] & left)[0]
                left[found] = False
                edges += [(node, int(child)) for child in found]
                ahead += found.tolist()
            level = ahead
    return edges


def _masks(bits: int) -> list[int]:
    """For each choice of three of the blocks: the mask of their bits, signed."""
    cuts = np.linspace(0, 64, bits + 4).round().astype(int)
    blocks = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(cuts, cuts[1:])]
    sums = [sum(chosen) for chosen in combinations(blocks, 3)]
    return [m - (1 << 64) if m >> 63 else m for m in sums]


def links(prints: DataFrame, bits: int = 3, chunk: int = CHUNK) -> DataFrame:
    """a, b: enough of the pairs of distinct fingerprints within ``bits`` to reach whatever the others reach."""
    choices = F.array(
        *[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(_masks(bits))]
    )
    keyed = prints.select("fp", F.explode(choices).alias("c")).select("fp", "c.t", "c.k")
    shared = keyed.groupBy("t", "k").agg(F.count("fp").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / chunk).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
    met = (
        keyed.join(shared, ["t", "k"])
        .select("t", "k", "fp", parts.alias("parts"))
        .select("t", "k", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .groupBy("t", "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        .agg(F.collect_list("fp").alias("fps"))
        .select("fps")
    )

    def work(batch: pa.RecordBatch) -> dict:
        a, b = [], []
        for fps in batch.column(0).to_pylist():
            values = np.array(fps, np.int64)
            whole = values.view(np.uint64)
            near = np.bitwise_count(whole[:, None] ^ whole[None, :]) <= bits
            for parent, child in forest(near):
                a.append(int(values[parent]))
                b.append(int(values[child]))
        return {"a": a, "b": b}

    return per_batch(met, work, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, bits: int = 3, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """key, fingerprint (16 hexadecimal digits), component_id (smallest key reachable by links)."""
    from tidemark.llm.common import stored

    made = stored(fingerprints(docs, shingle, text, key), "fingerprints")
    prints = made.groupBy("fp").agg(F.min(key).alias("least"))
    reached = components(links(prints.select("fp"), bits)).withColumnRenamed("node", "fp")
    grouped = prints.join(reached, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = grouped.join(least, "component").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return made.join(by_print, "fp").select(key, digits.alias("fingerprint"), "component_id")


def kept_documents(docs: DataFrame, shingle: int = 3, bits: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, the one with the smallest key.

    Of rows that share that key, the one whose text has the least hash stays, and one of its copies. Documents without
    a key do not give way to those with one: of them, one of each group stays as well.
    """
    from tidemark.llm.common import stored

    same, other = fresh(docs, "same"), fresh(docs, "other")
    # A row is known by its key and text; two hashes of 64 bits name it, so null keys are like any other.
    names = [F.xxhash64(F.lit(i), F.col(key).isNull(), F.col(key), F.col(text)) for i in (0, 1)]
    kind = docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> dict:
        made = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
        prints = np.array(made, np.uint64).view(np.int64)
        return {"key": batch.column(0), "same": batch.column(2), "other": batch.column(3), "fp": prints}

    marked = docs.select(F.col(key), F.col(text), names[0].alias(same), names[1].alias(other))
    made = stored(per_batch(marked, work, f"key {kind}, same long, other long, fp long"), "fingerprints")
    keyless = F.col("key").isNull().alias("keyless")
    prints = made.groupBy("fp", keyless).agg(F.min(F.struct("key", "same", "other")).alias("first"))
    reached = components(links(prints.select("fp").distinct(), bits)).withColumnRenamed("node", "fp")
    grouped = prints.join(reached, "fp", "left").groupBy(F.coalesce("component", "fp").alias("component"), "keyless")
    chosen = grouped.agg(F.min("first").alias("first")).select(F.col("first.same").alias(same), F.col("first.other").alias(other))
    # Copies are merged per task, before the shuffle by which the join goes too.
    once = docs.withColumns({same: names[0], other: names[1]}).dropDuplicates([same, other])
    return once.join(chosen, [same, other], "left_semi").select(docs.columns)
