"""Toxicity by weak supervision.

Voters look at a text and vote toxic, not toxic, or abstain: fixed lists of insults, threats and slurs of contempt,
patterns (an insult told to the reader), and lists mined from the labelled training rows: words and word beginnings
far more frequent in toxic texts, dealt to several voters. A generative label model estimates, by expectation
maximisation over the vote patterns of all texts, how often each voter votes what under either label; labelled
training rows hold their label. What two voters share beyond the label is measured as correlation, and a voter's
evidence is divided by the number of voters it effectively repeats. The model's posterior labels of training rows train
a linear classifier on the mined words and the votes; its logistic output is the score of any text.

Labels come only from rows of the training folds. Lists are mined from all labelled training rows; only the linear
classifier is fitted on about SAMPLE of them, chosen by hash (all, where there are fewer). Votes, patterns and the label
model cover all texts. Null and empty texts get the score of a text without any feature. Without labels or toxic examples the fixed lists alone vote. Repeated rows are scored row by row; a null key is in the fold of the empty
text and has no label; empty tables give empty results; no other column is read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, per_batch, stored

#: Labelled training rows the linear classifier is fitted on, about; and features it knows, at most.
SAMPLE = 40_000
FEATURES = 4_000
#: A mined feature stands in so many toxic training texts, and there so many times as often as in others.
LEAST_TEXTS, LEAST_LIFT = 5, 4.0
#: Lengths of word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6)
MINED_VOTERS = 4

#: Fixed lists, one voter each.
LISTS = {
    "insult": """idiot idiots moron morons stupid dumb dumbass fool imbecile loser losers clown cretin retard retarded
        jerk dummkopf trottel blödmann vollidiot idiota estúpido imbécil tonto idiote stupide crétin connard abruti""",
    "contempt": """pathetic worthless disgusting trash garbage scum filth vermin useless pig swine abschaum dreck
        wertlos ekelhaft widerlich basura escoria asqueroso inútil patético ordure racaille déchet minable dégoûtant""",
    "profanity": """fuck fucking shit bitch bastard asshole crap damn cunt whore slut scheiße arschloch hure
        mierda puta cabrón merde putain salope""",
    "threat": """kill murder hang strangle die stab shoot burn töten umbringen sterben matar muere morir tuer crever
        mourir""",
}
#: Fixed patterns, one voter together: an insult told to the reader, and calls to harm.
PATTERNS = (
    r"\b(?:you|u|ur|you're|your)\b(?:\s+\w+){0,3}\s+(?:idiot|moron|loser|clown|scum|trash|garbage|pig|bitch|fool)",
    r"\b(?:shut up|go to hell|drop dead|kill yourself|nobody likes you|i hate you|halt die klappe|ta gueule|cállate)\b",
)

_WORD = re.compile(r"[^\W\d_]+")
_PATTERN = re.compile("|".join(PATTERNS))
_LISTS = {name: frozenset(words.split()) for name, words in LISTS.items()}


def _words(text: str | None) -> list[str]:
    return list(dict.fromkeys(_WORD.findall((text or "").lower())))


def features(words: list[str]) -> set[str]:
    """Distinct words, and beginnings of the longer ones (marked by a star)."""
    found = set(words)
    for n in BEGINNINGS:
        found.update(w[:n] + "*" for w in words if len(w) > n)
    return found


class Voters:
    """The fixed and mined voters. ``mined``: feature -> number."""

    def __init__(self, mined: dict[str, int]):
        self.mined = mined
        self.group = {number: zlib.crc32(f.encode()) % MINED_VOTERS for f, number in mined.items()}
        self.names = [*LISTS, "pattern", *[f"mined{i}" for i in range(MINED_VOTERS)]]

    def look(self, text: str | None) -> tuple[list[int], list[int]]:
        """Numbers of the mined features found, and the votes: 1 toxic, -1 not toxic, 0 abstains."""
        lower = (text or "").lower()
        words = set(_WORD.findall(lower))
        mined = self.mined
        numbers = {mined[w] for w in words & mined.keys()}
        for n in BEGINNINGS:
            numbers.update(mined[b] for b in {w[:n] + "*" for w in words if len(w) > n} & mined.keys())
        votes = [1 if words & _LISTS[name] else 0 for name in _LISTS]
        votes.append(1 if _PATTERN.search(lower) else 0)
        hit = {self.group[n] for n in numbers}
        # Mined lists know the corpus, so their silence on a text of some length is evidence.
        silent = -1 if len(words) >= 5 else 0
        votes += [1 if g in hit else silent for g in range(MINED_VOTERS)]
        return sorted(numbers), votes


def _coded(votes: np.ndarray) -> np.ndarray:
    """Each row of votes as one number of base three."""
    return ((votes + 1) * 3 ** np.arange(votes.shape[1])).sum(axis=1)


def _decoded(codes: np.ndarray, voters: int) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(voters) % 3 - 1


@lru_cache(maxsize=1)
def _voters(mined: tuple[str, ...]) -> Voters:
    return Voters({f: i for i, f in enumerate(mined)})


class LabelModel:
    """P(vote | label) of every voter, estimated over vote patterns; evidence tempered by correlation."""

    def __init__(self, voters: int):
        self.tables = np.full((2, voters, 3), 1 / 3)
        self.prior = 0.1
        self.weight = np.ones(voters)

    def evidence(self, votes: np.ndarray) -> np.ndarray:
        """Log-odds of label 1 from each row of votes."""
        logs = np.log(self.tables[1]) - np.log(self.tables[0])
        each = logs[np.arange(votes.shape[1]), votes + 1] * self.weight
        return each.sum(axis=1) + math.log(self.prior / (1 - self.prior))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(votes), -30, 30)))

    def fit(self, votes: np.ndarray, free: np.ndarray, labelled: np.ndarray, steps: int = 30) -> LabelModel:
        """``votes``: distinct patterns; ``free``: texts with each; ``labelled``: (2, patterns) rows of known label."""
        onehot = (votes[:, :, None] + 1 == np.arange(3)).astype(float)
        known = labelled.sum()
        if labelled[1].sum() and labelled[0].sum():
            start = labelled[1] + 0.5, labelled[0] + 0.5
            self.prior = float(np.clip(labelled[1].sum() / known, 0.001, 0.5))
        else:
            toxic = (votes > 0).any(axis=1)
            start = free * toxic + 0.01, free * ~toxic + 0.01
        for y, mass in ((1, start[0]), (0, start[1])):
            self.tables[y] = self._table(onehot, mass)
        # Known labels weigh as much as all the texts without: else a large topic may take over the classes.
        lift = max(1.0, free.sum() / known) if known else 1.0
        for _ in range(steps):
            self._correlate(votes, free, onehot)
            soft = self.posterior(votes)
            for y, share in ((1, soft), (0, 1 - soft)):
                self.tables[y] = self._table(onehot, free * share + lift * labelled[y])
        return self

    @staticmethod
    def _table(onehot: np.ndarray, mass: np.ndarray) -> np.ndarray:
        sums = np.einsum("p,pvk->vk", mass, onehot) + 0.5
        return sums / sums.sum(axis=1, keepdims=True)

    def _correlate(self, votes: np.ndarray, mass: np.ndarray, onehot: np.ndarray) -> None:
        """Weight of a voter: one over one plus its correlations with the others, given the label."""
        soft = self.posterior(votes)
        total = np.zeros((votes.shape[1],) * 2)
        scale = np.zeros(votes.shape[1])
        for y, share in ((1, soft), (0, 1 - soft)):
            w = mass * share
            mean = (w[:, None] * votes).sum(axis=0) / max(w.sum(), 1e-9)
            off = votes - mean
            cov = (w[:, None] * off).T @ off
            total += cov
            scale += np.diag(cov)
        spread = np.sqrt(np.maximum(np.outer(scale, scale), 1e-12))
        linked = np.clip(total / spread, 0, 1)
        np.fill_diagonal(linked, 0)
        self.weight = 1 / (1 + linked.sum(axis=1))


def _linear(rows: list[list[int]], dense: np.ndarray, target: np.ndarray, size: int, steps: int = 150):
    """Logistic regression on soft labels over sparse and dense features (AdaGrad, full batches)."""
    index = np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, d, b = np.zeros(size), np.zeros(dense.shape[1]), 0.0
    sums = [np.full(size, 1e-6), np.full(dense.shape[1], 1e-6), 1e-6]
    decay = 1e-4
    for _ in range(steps):
        z = np.bincount(owner, w[index], len(rows)) + dense @ d + b
        error = target - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        grads = [np.bincount(index, error[owner], size) / len(rows) - decay * w, dense.T @ error / len(rows) - decay * d, error.mean()]
        for i, g in enumerate(grads):
            sums[i] = sums[i] + g * g
        w += 0.5 * grads[0] / np.sqrt(sums[0])
        d += 0.5 * grads[1] / np.sqrt(sums[1])
        b += 0.5 * grads[2] / math.sqrt(sums[2])
    return w, d, b


def mine(training: DataFrame) -> list[str]:
    """Features of toxic training texts by how much more often they stand there.

    ``training``: words (the distinct words of a text, parted by spaces), toxic.
    """

    def count(batch: pa.RecordBatch) -> dict:
        # The feature without a name counts the texts.
        found: dict[str | None, list[int]] = {None: [0, 0]}
        for words, toxic in zip(*[c.to_pylist() for c in batch.columns]):
            for feature in (None, *features(words.split())):
                found.setdefault(feature, [0, 0])[toxic] += 1
        clean, toxic = zip(*found.values())
        return {"feature": list(found), "clean": clean, "toxic": toxic}

    counted = per_batch(training.select("words", F.col("toxic").cast("int")), count, "feature string, clean long, toxic long")
    counted = stored(counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(
        (F.col("toxic") >= LEAST_TEXTS) | F.col("feature").isNull()
    ), "features")
    texts = counted.where("feature is null").first()
    if not texts:
        return []
    lift = F.col("toxic") / (F.col("clean") + 0.5) * F.lit((texts["clean"] + 1) / (texts["toxic"] + 1))
    good = counted.where(F.col("feature").isNotNull() & (lift >= LEAST_LIFT))
    # Every feature's lift is known before any is left out.
    best = good.orderBy((F.log(lift) * F.col("toxic")).desc(), F.col("feature").desc()).limit(FEATURES)
    return [r["feature"] for r in best.select("feature").collect()]


def score(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """key, held_out, score, predicted of every row of ``docs``; ``labels``: key, toxic (0, 1 or null)."""
    docs = docs.select(F.col(key), F.col(text).alias("text"), (fold(F.col(key), folds) == held).alias("held_out"))
    known = labels.where(F.col("toxic").isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max("toxic").alias("toxic"))
    known = known.where(fold(F.col(key), folds) != held)
    total = known.count()
    share = min(1.0, SAMPLE / total) if total else 0.0
    chosen = known.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < int(share * 1_000_000))
    kind = docs.schema[key].dataType.simpleString()

    def bag(batch: pa.RecordBatch) -> dict:
        return {key: batch.column(0), "words": [" ".join(_words(t)) for t in batch.column(1).to_pylist()]}

    bags = docs.where(~F.col("held_out") & F.col(key).isNotNull()).select(key, "text")
    # Only the distinct words of a text move to its label, once, and by the same join whatever the size.
    training = per_batch(bags, bag, f"{key} {kind}, words string").join(known.hint("merge"), key)
    mined = tuple(mine(training))
    names = _voters(mined).names

    def look(batch: pa.RecordBatch) -> dict:
        voters = _voters(mined)
        made = [voters.look(t) for t in batch.column(1).to_pylist()]
        return {
            key: batch.column(0), "held_out": batch.column(2), "found": [m[0] for m in made],
            "votes": _coded(np.array([m[1] for m in made])),
        }

    seen = stored(
        per_batch(docs.select(key, "text", "held_out"), look, f"{key} {kind}, held_out boolean, found array<int>, votes long"),
        "votes",
    )
    labelled = seen.select(key, "votes").join(known.withColumnRenamed("toxic", "label"), key, "left")
    # Votes have three values, so the patterns are few and bounded by 3 ^ voters, whatever the number of texts.
    patterns = labelled.groupBy("votes").agg(
        F.count(F.when(F.col("label").isNull(), 1)).alias("free"),
        F.count(F.when(F.col("label") == 1, 1)).alias("toxic"),
        F.count(F.when(F.col("label") == 0, 1)).alias("clean"),
    )
    rows = sorted(patterns.collect(), key=lambda r: r["votes"])
    if not rows:
        return seen.select(key, "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    votes = _decoded(np.array([r["votes"] for r in rows]), len(names))
    known_mass = np.array([[r["clean"] for r in rows], [r["toxic"] for r in rows]], float)
    model = LabelModel(len(names)).fit(votes, np.array([r["free"] for r in rows], float), known_mass)
    # About SAMPLE rows of a key and a number, whatever the input.
    sample = seen.join(F.broadcast(chosen.withColumnRenamed("toxic", "label")), key)
    sample = sample.select(key, "found", "votes", "label").dropDuplicates([key]).collect()
    sample = sorted(sample, key=lambda r: (r[key], r["found"]))
    if sample:
        own = _decoded(np.array([r["votes"] for r in sample]), len(names))
        soft = model.posterior(own)
        # The posterior of a labelled row takes its label as one more, reliable vote.
        told = np.array([r["label"] for r in sample], float)
        target = 1 / (1 + np.exp(-np.clip(np.log(soft + 1e-9) - np.log(1 - soft + 1e-9) + 4 * (2 * told - 1), -30, 30)))
        w, d, b = _linear([r["found"] for r in sample], own.astype(float), target, max(1, len(mined)))
    else:
        w, d, b = None, None, 0.0

    def judge(batch: pa.RecordBatch) -> dict:
        own = _decoded(np.asarray(batch.column(3), np.int64), len(names))
        if w is None:
            out = model.posterior(own)
        else:
            z = own @ d + b + np.array([w[f].sum() if f else 0.0 for f in batch.column(2).to_pylist()])
            out = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return {key: batch.column(0), "held_out": batch.column(1), "score": out, "predicted": (out >= 0.5).astype(np.int32)}

    return per_batch(seen, judge, f"{key} {kind}, held_out boolean, score double, predicted int")
