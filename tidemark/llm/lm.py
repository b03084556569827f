"""A log-bilinear language model trained by noise-contrastive estimation.

Words become units: each of the most frequent words is its own, the others share units by their last letters, the
end of a text is one. The representation predicted from the two preceding units is C1 r(u) + C2 r(v); its product
with a unit's output vector, plus a bias, is the unit's score. Training tells the true unit from sampled noise units
(logistic loss against log(k pn)), so no normaliser is needed there: every task runs stochastic steps over its own
documents, and a round ends with the average of the tasks' parameters, weighted by their tokens.

Scoring is normalised exactly. With two context units the scores split into A1[u, w] + A2[v, w], hence the normalisers
of all contexts are the single matrix product exp(A1) exp(A2)^T. Within a shared unit a word has the share
(c + 1) / (sum of c + 1 over the unit's words, plus 1), the last 1 being the place of all words not seen in training; the
probabilities of a context thus sum to one.

Counts cover all training texts; only the frequent words (at most FREQUENT) and the parameters travel to the tasks,
counts of rare words reach their texts by a join. Null texts are empty and have one token, the end; a null key counts as the
empty text for the fold; empty tables give empty results; repeated rows count and are scored row by row.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    bounded_batches,
    fold,
    most_frequent,
    numbered_values,
    per_batch,
    stored,
    words_of,
)

#: Words whose counts are at hand in every task.
FREQUENT = 60_000
#: Units: the end, words of their own, and those shared by rare words.
OWN, SHARED = 767, 256
UNITS = 1 + OWN + SHARED
WIDTH = 16
NOISE = 64
STEP_TOKENS = 4096
ROUNDS = 2
#: Tables of parameters added up in one task.
FAN_IN = 16
RATE = 0.15


def words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case."""
    return (text or "").encode().lower().split()


def numbered(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Words of a batch of texts as numbers, the distinct words, and the row of each word."""
    found, row = words_of(texts)
    number, distinct = numbered_values(found)
    return number, distinct.to_pylist(), row


def shared_unit(word: bytes) -> int:
    """The shared unit of a word: by its last three letters, which tell languages and kinds of words apart."""
    return 1 + OWN + zlib.crc32(word[-3:]) % SHARED


def start(frequencies: np.ndarray, width: int = WIDTH, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters before training: small vectors, biases at the units' log frequencies."""
    rng = np.random.default_rng(seed)
    units = len(frequencies)
    return {
        "r": rng.normal(0, 0.3, (units, width)).astype(np.float32),
        "q": rng.normal(0, 0.1, (units, width)).astype(np.float32),
        "c1": (0.5 * np.eye(width)).astype(np.float32),
        "c2": (0.5 * np.eye(width)).astype(np.float32),
        "b": np.log(frequencies).astype(np.float32),
    }


def _spread(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sum of rows by index."""
    width = rows.shape[1]
    flat = (index[:, None] * width + np.arange(width)).ravel()
    return np.bincount(flat, rows.ravel(), size * width).reshape(size, width).astype(np.float32)


class Trainer:
    """Noise-contrastive steps with per-weight step sizes (AdaGrad)."""

    def __init__(self, p: dict[str, np.ndarray], frequencies: np.ndarray, seed: int):
        self.p = {k: v.copy() for k, v in p.items()}
        self.sums = {k: np.full(v.shape, 1e-3, np.float32) for k, v in p.items()}
        self.log_noise = (np.log(frequencies) + math.log(NOISE)).astype(np.float32)
        self.cumulative = np.cumsum(frequencies)
        self.rng = np.random.default_rng(seed)
        self.tokens = 0

    def step(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> None:
        p, n = self.p, len(w)
        noise = np.searchsorted(self.cumulative, self.rng.random(NOISE) * self.cumulative[-1]).clip(0, UNITS - 1)
        ru, rv, qw, qn = p["r"][u], p["r"][v], p["q"][w], p["q"][noise]
        predicted = ru @ p["c1"] + rv @ p["c2"]
        true = 1 / (1 + np.exp((predicted * qw).sum(axis=1) + p["b"][w] - self.log_noise[w]))
        false = predicted @ qn.T + (p["b"][noise] - self.log_noise[noise])
        false = -1 / (1 + np.exp(-false))
        back = true[:, None] * qw + false @ qn
        units = len(p["b"])
        grads = {
            "q": _spread(np.concatenate([w, noise]), np.concatenate([true[:, None] * predicted, false.T @ predicted]), units),
            "b": np.bincount(np.concatenate([w, noise]), np.concatenate([true, false.sum(axis=0)]), units),
            "c1": ru.T @ back,
            "c2": rv.T @ back,
            "r": _spread(np.concatenate([u, v]), np.concatenate([back @ p["c1"].T, back @ p["c2"].T]), units),
        }
        for name, g in grads.items():
            g = (g / n).astype(np.float32)
            self.sums[name] += g * g
            p[name] += RATE * g / np.sqrt(self.sums[name])
        self.tokens += n

    def learn(self, ids: np.ndarray, starts: np.ndarray) -> None:
        """All tokens of a run of texts, each led by two ends, which are context only, and closed by one."""
        token = np.ones(len(ids), bool)
        token[starts] = False
        token[starts + 1] = False
        where = np.nonzero(token)[0]
        self.rng.shuffle(where)
        for at in range(0, len(where), STEP_TOKENS):
            k = where[at : at + STEP_TOKENS]
            self.step(ids[k - 2], ids[k - 1], ids[k])


def _pack(p: dict[str, np.ndarray]) -> bytes:
    return b"".join(p[k].astype(np.float32).tobytes() for k in ("r", "q", "c1", "c2", "b"))


def _unpack(flat: np.ndarray, units: int = UNITS, width: int = WIDTH) -> dict[str, np.ndarray]:
    shapes = {"r": (units, width), "q": (units, width), "c1": (width, width), "c2": (width, width), "b": (units,)}
    out, at = {}, 0
    for name, shape in shapes.items():
        size = math.prod(shape)
        out[name] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def log_probabilities(p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A1, A2, log Z: log P(w | u, v) = A1[u, w] + A2[v, w] - logZ[u, v]."""
    a1 = p["r"] @ p["c1"] @ p["q"].T
    a2 = p["r"] @ p["c2"] @ p["q"].T + p["b"]
    m1, m2 = a1.max(axis=1, keepdims=True), a2.max(axis=1, keepdims=True)
    z = np.exp((a1 - m1).astype(np.float64)) @ np.exp((a2 - m2).astype(np.float64)).T
    return a1, a2, (np.log(z) + m1 + m2.T).astype(np.float32)


@lru_cache(maxsize=1)
def _tables(packed: bytes):
    return log_probabilities(_unpack(np.frombuffer(packed, np.float32)))


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word (binary), c: the words of all texts, counted per batch before the shuffle."""

    def work(batch: pa.RecordBatch) -> dict:
        found, _ = words_of(batch.column(0))
        number, distinct = numbered_values(found)
        return {"word": distinct.cast(pa.binary()), "c": np.bincount(number, minlength=len(distinct))}

    made = per_batch(docs.select(text), work, "word binary, c long")
    return made.groupBy("word").agg(F.sum("c").alias("c"))


def train(texts: DataFrame, frequencies: np.ndarray, rounds: int = ROUNDS):
    """Parameters after ``rounds`` passes over the ``units`` of texts (their words' units and the end).

    The tasks' sums of parameters are added up in groups of FAN_IN until no more are left than the driver adds.
    """
    bounded_batches(texts.sparkSession)
    p = start(frequencies)
    schema = "slot long, n long, sums binary"
    for round_ in range(rounds):
        packed = _pack(p)

        def work(batches, packed=packed, round_=round_):
            from pyspark import TaskContext

            trainer = Trainer(_unpack(np.frombuffer(packed, np.float32)), frequencies, 31 + round_)
            for batch in batches:
                if batch.num_rows:
                    trainer.learn(*led(batch.column(0)))
            if trainer.tokens:
                flat = np.frombuffer(_pack(trainer.p), np.float32).astype(np.float64) * trainer.tokens
                slot = TaskContext.get().partitionId()
                yield _sums(slot, trainer.tokens, flat)

        def add(key, group):
            rows = sorted(group.to_pylist(), key=lambda r: r["slot"])
            flats = sum(np.frombuffer(r["sums"], np.float64) for r in rows)
            return pa.Table.from_batches([_sums(rows[0]["slot"] // FAN_IN, sum(r["n"] for r in rows), flats)])

        parts = stored(texts.select("units").mapInArrow(work, schema), "sums")
        while parts.count() > FAN_IN:
            parts = stored(parts.groupBy(F.expr(f"slot div {FAN_IN}").alias("of")).applyInArrow(add, schema), "sums")
        rows = sorted(parts.collect(), key=lambda r: r["slot"])
        if not rows:
            break
        p = _unpack(sum(np.frombuffer(r["sums"], np.float64) for r in rows) / sum(r["n"] for r in rows))
    return p


def _sums(slot: int, tokens: int, flat: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([slot], pa.int64()), pa.array([tokens], pa.int64()), pa.array([flat.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["slot", "n", "sums"])


def led(units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The units of a batch of texts in a row, each text led by two ends, and where the texts start."""
    sizes = np.diff(units.offsets.to_numpy().astype(np.int64))
    starts = np.concatenate([[0], np.cumsum(sizes[:-1] + 2)]) if len(sizes) else sizes
    ids = np.zeros(int((sizes + 2).sum()), np.int64)
    place = np.arange(int(sizes.sum())) + np.repeat(2 * np.arange(1, len(sizes) + 1), sizes)
    ids[place] = units.flatten().to_numpy(zero_copy_only=False)
    return ids, starts


def score(docs: DataFrame, folds: int = 7, held: int = 2, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    docs = docs.select(F.col(key), F.col(text).alias("text"), (fold(F.col(key), folds) == held).alias("held_out"))
    training = docs.where("not held_out")
    known = stored(counts(training), "counts")
    texts = training.count()
    totals = known.agg(F.count("word"), F.sum("c")).first()
    n, v = (totals[1] or 0) + texts, totals[0] + (1 if texts else 0)
    # At most FREQUENT rows come to the driver, whatever the input.
    top = sorted(most_frequent(known, "c", FREQUENT).collect(), key=lambda r: (-r["c"], bytes(r["word"])))
    frequent = {bytes(r["word"]): math.log10(r["c"] + 1) for r in top}
    own = tuple(bytes(r["word"]) for r in top[:OWN])

    def of_shared(batch: pa.RecordBatch) -> dict:
        mine, mass = set(own), np.zeros(SHARED, np.int64)
        for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if w not in mine:
                mass[shared_unit(w) - 1 - OWN] += c + 1
        return {"unit": np.arange(SHARED), "mass": mass}

    sums = per_batch(known, of_shared, "unit long, mass long").groupBy("unit").agg(F.sum("mass").alias("mass"))
    mass = np.ones(SHARED)
    for r in sums.collect():
        mass[r["unit"]] += r["mass"]
    frequencies = np.concatenate([[texts + 1], [r["c"] + 1 for r in top[:OWN]], np.ones(OWN - len(own)), mass]) / (n + v + 1)
    frequencies = frequencies / frequencies.sum()
    log_mass, log_all, end_count = np.log10(mass), math.log10(n + v + 1), math.log10(texts + 1)
    at_hand = docs.sparkSession.sparkContext.broadcast((frequent, {w: i + 1 for i, w in enumerate(own)}))

    def read(batch: pa.RecordBatch) -> dict:
        """Every text's units and what its frequent words count; every rare word with the rows that have it."""
        known_log, of_own = at_hand.value
        number, distinct, row = numbered(batch.column(1))
        size = batch.num_rows
        value = np.array([known_log.get(w, np.nan) for w in distinct], np.float64)
        unit = np.array([of_own.get(w) or shared_unit(w) for w in distinct], np.int16)
        unknown = np.isnan(value)
        known, units = ~unknown[number], unit[number]
        values = value[number]
        shared = known & (units > OWN)
        lengths = np.bincount(row, minlength=size)
        ends = np.cumsum(lengths + 1)
        ids = np.zeros(int(ends[-1]), np.int16)
        ids[np.arange(len(row)) + row] = units
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        # Rare words by word, each with its rows and how often it is there.
        rare, counts_ = np.unique(number[~known] * size + row[~known], return_counts=True)
        word, at = np.divmod(rare, size)
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else word
        lists = pa.array(np.append(first, len(word)).astype(np.int32))
        line, none = batch.column(0), len(first)
        empty = lambda kind: pa.nulls(none, kind)
        add = lambda mask: np.bincount(row[mask], values[mask], size).astype(np.float64)
        names = pa.array([distinct[i] for i in word[first].tolist()], pa.binary())
        columns = {
            "row": (line, empty(pa.int64())),
            key: (batch.column(2), empty(batch.column(2).type)),
            "held_out": (batch.column(3), empty(pa.bool_())),
            "n_tokens": (pa.array(lengths + 1), empty(pa.int64())),
            "n_known": (pa.array(np.bincount(row[known], minlength=size) + (1 if texts else 0)), empty(pa.int64())),
            "counted": (pa.array(add(known) + end_count), empty(pa.float64())),
            "of_own": (pa.array(add(shared)), empty(pa.float64())),
            "units": (pa.ListArray.from_arrays(offsets, pa.array(ids)), empty(pa.list_(pa.int16()))),
            "word": (pa.nulls(size, pa.binary()), names),
            "rows": (pa.nulls(size, pa.list_(pa.int64())), pa.ListArray.from_arrays(lists, line.take(pa.array(at)))),
            "times": (pa.nulls(size, pa.list_(pa.int64())), pa.ListArray.from_arrays(lists, pa.array(counts_))),
        }
        return {k: pa.concat_arrays(list(v)) for k, v in columns.items()}

    kind = docs.schema[key].dataType.simpleString()
    own_columns = f"row long, `{key}` {kind}, held_out boolean, n_tokens long, n_known long, counted double, "
    schema = f"{own_columns}of_own double, units array<short>, word binary, rows array<long>, times array<long>"
    numbered_docs = docs.select(F.monotonically_increasing_id().alias("row"), "text", key, "held_out")
    made = stored(per_batch(numbered_docs, read, schema), "read")
    lines = made.where("word is null")
    packed = _pack(train(lines.where("not held_out"), frequencies))

    def work(batch: pa.RecordBatch) -> dict:
        a1, a2, log_z = _tables(packed)
        ids, starts = led(batch.column("units"))
        token = np.ones(len(ids), bool)
        token[starts] = token[starts + 1] = False
        at = np.flatnonzero(token)
        u, v, w = ids[at - 2], ids[at - 1], ids[at]
        logs = (a1[u, w].astype(np.float64) + a2[v, w] - log_z[u, v]) / math.log(10)
        logs[w > OWN] -= log_mass[w[w > OWN] - 1 - OWN]
        firsts = starts - 2 * np.arange(len(starts))
        model = np.add.reduceat(logs, firsts) + batch.column("of_own").to_numpy()
        passed = ("row", key, "held_out", "n_tokens", "n_known", "counted")
        return {**{c: batch.column(c) for c in passed}, "model": model}

    scored = per_batch(lines.drop("word", "rows", "times"), work, f"{own_columns}model double")
    rare = made.where("word is not null").select("word", "rows", "times").join(known, "word")
    rare = rare.select(F.explode(F.arrays_zip("rows", "times")).alias("x"), F.log10(F.col("c") + 1).alias("value"), "c")
    rare = rare.select(F.col("x.rows").alias("row"), F.col("x.times").alias("times"), "value").groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.col("value")).alias("rest")
    )
    rest = F.coalesce("rest", F.lit(0.0))
    return scored.join(rare, "row", "left").select(
        key,
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("counted") + rest - F.col("n_tokens") * F.lit(log_all)).alias("base_score"),
        (F.col("model") + rest).alias("score"),
    )
