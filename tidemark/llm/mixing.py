"""Mixing sources to target weights by the cube method.

Each source has a target of words; a document of that source is to be taken target / source size times on
average. The whole part is taken outright, the rest is an inclusion probability. The flight phase moves the
probabilities of three documents at a time along the null space of the two balancing totals (documents and words)
until one of them is 0 or 1, so both totals stay as they were. It runs in chunks of a source, dealt by a hash of
the key; a chunk leaves at most two open documents, which are dealt anew into far fewer chunks, until one chunk
per source is left. What is then open (at most two documents per source) lands on the choice whose words are
nearest, helped by one exchange within that last chunk.

Deterministic: chunks, their order and every random choice come from hashes of the key, text and text size, so
reruns and other partitionings agree; repeated rows are numbered, and dealt by their number too. Null texts have size 0 and, like any text without words, are taken 0 words;
null sources form a source of their own, last in order; a document with a null key keeps its row. Which of the
rows equal in key and text has which number makes no difference. Empty tables give empty results; other columns are kept by ``mixed_documents``.
"""

from __future__ import annotations

import math
import random
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fresh, per_batch, stored, word_count

#: Documents of one source that fly together.
CHUNK = 2000
#: Numerical distance from 0 and 1 at which a probability counts as decided.
_EPSILON = 1e-9


def flight(probabilities: list[float], sizes: list[float], rng: random.Random) -> list[float]:
    """Probabilities after the flight phase: at most two are neither 0 nor 1; both totals are unchanged."""
    p = list(probabilities)
    open_ = [i for i, x in enumerate(p) if _EPSILON < x < 1 - _EPSILON]
    waiting = iter(open_)
    three: list[int] = []
    while True:
        while len(three) < 3 and (i := next(waiting, None)) is not None:
            three.append(i)
        if len(three) < 3:
            return [float(round(x)) if not _EPSILON < x < 1 - _EPSILON else x for x in p]
        a, b, c = three
        # Orthogonal to (1, 1, 1) and to the sizes; equal sizes leave a free choice.
        move = [sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b]]
        if not any(move):
            move = [1.0, -1.0, 0.0]
        ends = []
        for sign in (1, -1):
            ends.append(
                min(
                    ((1 - p[i]) if sign * m > 0 else p[i]) / abs(m)
                    for i, m in zip(three, move)
                    if m
                )
            )
        forward = rng.random() < ends[1] / (ends[0] + ends[1])
        step = ends[0] if forward else -ends[1]
        for i, m in zip(three, move):
            p[i] = min(1.0, max(0.0, p[i] + step * m))
        three = [i for i in three if _EPSILON < p[i] < 1 - _EPSILON]


def landing(probabilities: list[float], sizes: list[float], promised: float) -> list[float]:
    """The few open probabilities decided so that the words come nearest to ``promised``.

    What still differs is mended by exchanging one taken document for one left out, which keeps their number.
    """
    open_ = [i for i, x in enumerate(probabilities) if 0 < x < 1]
    taken = sum(s for x, s in zip(probabilities, sizes) if x == 1)
    choices = [sum(sizes[i] for k, i in enumerate(open_) if c >> k & 1) for c in range(1 << len(open_))]
    best = min(range(len(choices)), key=lambda c: (abs(promised - taken - choices[c]), c))
    out = list(probabilities)
    for k, i in enumerate(open_):
        out[i] = float(best >> k & 1)
    excess = taken + choices[best] - promised
    left = sorted((sizes[i], i) for i, x in enumerate(out) if x == 0)
    exchange, least = None, abs(excess)
    for i, x in enumerate(out):
        if x == 1:
            near = bisect_left(left, (sizes[i] - excess, -1))
            for size, j in left[max(0, near - 1) : near + 1]:
                if abs(excess - sizes[i] + size) < least:
                    exchange, least = (i, j), abs(excess - sizes[i] + size)
    if exchange:
        out[exchange[0]], out[exchange[1]] = 0.0, 1.0
    return out


def shares(sizes: list[int], weights: list[float], total: float, most: float = 2.0) -> list[float]:
    """Targets by weight that stop at ``most`` times the size, the excess reshared until none is above."""
    targets, free, rest = [0.0] * len(sizes), {i for i, s in enumerate(sizes) if s > 0}, float(total)
    while free:
        sum_ = sum(weights[i] for i in free)
        full = {i for i in free if rest * weights[i] / sum_ > most * sizes[i]}
        if not full:
            for i in free:
                targets[i] = rest * weights[i] / sum_
            break
        for i in full:
            targets[i] = most * sizes[i]
        rest -= sum(targets[i] for i in full)
        free -= full
    return targets


def targets(sized: DataFrame, weights=(5.0, 2.0, 1.0), share: float = 1.5) -> DataFrame:
    """source, n_docs, source_size, target. One row per source passes through the driver, no more."""
    per = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    rows = sorted(per.collect(), key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be")))
    sizes = [r["source_size"] for r in rows]
    found = shares(sizes, [weights[i % len(weights)] for i in range(len(rows))], share * sum(sizes))
    schema = T.StructType(
        [
            T.StructField("source", T.StringType()),
            T.StructField("n_docs", T.LongType()),
            T.StructField("source_size", T.LongType()),
            T.StructField("target", T.DoubleType()),
        ]
    )
    return sized.sparkSession.createDataFrame(
        [(r["source"], r["n_docs"], s, t) for r, s, t in zip(rows, sizes, found)], schema
    )


def _fly(groups: DataFrame, last: bool) -> DataFrame:
    """One flight over each row's ``units`` (row, size, p); ``last`` lands as well."""

    def work(batch: pa.RecordBatch) -> dict:
        rows, sizes, ps = [], [], []
        for units in batch.column(0).to_pylist():
            units.sort(key=lambda u: (u["h"], u["row"]))
            rng = random.Random(units[0]["h"])
            own = [float(u["size"]) for u in units]
            promised = sum(u["p"] * size for u, size in zip(units, own))
            p = flight([u["p"] for u in units], own, rng)
            p = landing(p, own, promised) if last else p
            rows += [u["row"] for u in units]
            sizes += [u["size"] for u in units]
            ps += p
        return {"row": rows, "size": sizes, "p": ps}

    return per_batch(groups.select("units"), work, "row long, size long, p double")


def _numbered(units: DataFrame) -> DataFrame:
    """``units`` with rows of one source and hash ``h`` told apart by their number in a new ``h``; the first keeps its own.

    They are numbered within each task's rows and then by the counts of the tasks before, so no window holds
    all of them; which of the equal rows has which number makes no difference.
    """
    units = units.withColumn("task", F.shiftright("row", 33))
    # A third of a table may be one row: its rows are parted by hundreds as well, as the row number is dense in a task.
    units = units.withColumn("piece", F.floor(F.col("row").bitwiseAND((1 << 33) - 1) / 1000))
    counted = units.groupBy("source", "h", "task", "piece").agg(F.count(F.lit(1)).alias("n"))
    several = Window.partitionBy("source", "h").orderBy("task", "piece")
    before = counted.withColumn("before", F.sum("n").over(several) - F.col("n"))
    repeated = before.withColumn("most", F.max("before").over(Window.partitionBy("source", "h"))).where("n > 1 or most > 0")
    local = F.row_number().over(Window.partitionBy("source", "h", "task", "piece").orderBy("row")) - 1
    met = units.withColumn("local", local).alias("u").join(
        repeated.alias("b"), F.expr("u.source <=> b.source and u.h = b.h and u.task = b.task and u.piece = b.piece"), "left"
    )
    number = F.col("u.local") + F.coalesce("b.before", F.lit(0))
    own = F.when(number > 0, F.xxhash64("u.h", number)).otherwise(F.col("u.h"))
    return met.select("u.row", "u.size", "u.p", "u.source", "u.n_docs", own.alias("h"))


def mix(
    docs: DataFrame, weights=(5.0, 2.0, 1.0), share: float = 1.5, chunk: int = CHUNK,
    text: str = "text", key: str = "doc_id", source: str = "source",
) -> DataFrame:
    """key, size, source_size, target, taken (words), copies: how often the mix takes each document; text_hash."""
    sized = docs.select(F.col(key), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("text_hash"))
    # The row number only tells equal rows apart; the order of flights never depends on it otherwise.
    sized = stored(sized.withColumn("row", F.monotonically_increasing_id()), "sizes")
    goal = targets(sized, weights, share)
    most = max((r["n"] for r in goal.select(F.max("n_docs").alias("n")).collect() if r["n"]), default=0)
    known = (
        sized.alias("s")
        .join(goal.alias("g"), F.expr("s.source <=> g.source"))
        .select("s.row", f"s.{key}", "s.size", "s.source", "s.text_hash", "g.n_docs", "g.source_size", "g.target")
    )
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    known = known.withColumn("whole", F.floor(times)).withColumn("p", times - F.floor(times))
    order = F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.col("size"), F.col("text_hash"))
    units = known.select("row", "size", "p", "source", "n_docs", order.alias("h")).where(
        (F.col("p") > _EPSILON) & (F.col("p") < 1 - _EPSILON) & (F.col("size") > 0)
    )
    units = stored(_numbered(units), "units")
    decided = None
    levels = max(1, math.ceil(math.log(max(2, most), chunk // 2)))
    for level in range(levels):
        last = level == levels - 1
        parts = F.lit(1) if last else F.ceil(F.col("n_docs") / F.lit(float(chunk) * (chunk // 2) ** level))
        groups = units.groupBy("source", F.pmod("h", parts).alias("part")).agg(
            F.collect_list(F.struct("row", "size", "p", "h")).alias("units")
        )
        flown = stored(_fly(groups, last), "flown")
        now = flown.where("p = 0 or p = 1").select("row", "p")
        decided = now if decided is None else decided.union(now)
        if not last:
            units = units.drop("p").join(flown.where("p > 0 and p < 1").select("row", "p"), "row")
    # A probability that was decided from the start counts as it stands.
    copies = F.col("whole") + F.coalesce(F.col("q"), F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0))
    return (
        known.join(decided.withColumnRenamed("p", "q"), "row", "left")
        .withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("long"))
        .select(key, "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "text_hash")
    )


def mixed_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", **how) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with all its columns.

    Rows equal in key and text stand for each other: together they are taken as often as all of them are.
    """
    taken = mix(docs, text=text, key=key, **how).groupBy(key, "text_hash").agg(F.sum("copies").alias("copies"))
    own, same, copies, each = (fresh(docs, name) for name in ("own", "same", "copies", "each"))
    taken = taken.where("copies > 0").withColumnsRenamed({key: own, "text_hash": same, "copies": copies})
    hashed = fresh(docs, "hashed")
    once = docs.withColumn(hashed, F.xxhash64(text)).dropDuplicates([key, hashed])
    joined = once.join(taken, F.col(key).eqNullSafe(F.col(own)) & (F.col(hashed) == F.col(same)))
    return joined.withColumn(each, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(docs.columns)
