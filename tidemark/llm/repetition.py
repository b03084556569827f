"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths are built in numpy by doubling (2, 4, 8 words from 1, 2, 4), so a text
costs a few vector operations whatever its length. An n-gram found twice or more in the text marks all its words,
the first occurrence included; coverage is the share of word characters so marked. Lines are measured likewise:
the share of characters in lines that equal an earlier one. A text whose coverage passes a limit is rejected.

Nulls and texts without a word have no words, no coverage and fail the word minimum; empty tables give empty
results; repeated rows are judged row by row; columns beside the key and the text are ignored. A word's hash has
64 bits and never leaves the text, so equal hashes of unequal n-grams are not to be expected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, per_batch

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
#: Longest share of word characters inside n-grams found twice or more, by n; and inside repeated lines.
LIMITS = {5: 0.40, 8: 0.30, 10: 0.25}
LINE_LIMIT = 0.30
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True


def rolling(hashes: np.ndarray, lengths) -> dict[int, np.ndarray]:
    """Hash of every run of n words, for each n; ``hashes``: one 64-bit hash per word."""
    made, power, n = {1: hashes}, _BASE, 1
    powers = {1: _BASE}
    with np.errstate(over="ignore"):
        while 2 * n <= max(lengths):
            shorter = made[n]
            made[2 * n] = shorter[: len(shorter) - n] + shorter[n:] * power if len(shorter) > n else shorter[:0]
            power = power * power
            n *= 2
            powers[n] = power
        out = {}
        for length in lengths:
            rest, at, total, shift = length, 0, None, np.uint64(1)
            size = max(0, len(hashes) - length + 1)
            for part in sorted((p for p in made), reverse=True):
                if part <= rest:
                    piece = made[part][at : at + size]
                    total = piece * shift if total is None else total + piece * shift
                    shift, at, rest = shift * powers[part], at + part, rest - part
                    if part <= rest:
                        raise ValueError(f"no doubling reaches {length}")
            out[length] = total
    return out


def covered(keys: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which of the words lie in a run of n words whose key is found twice or more."""
    inside = np.zeros(words + 1, np.int32)
    if len(keys) > 1:
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        starts = np.nonzero(twice)[0]
        inside[starts] += 1
        np.add.at(inside, starts + n, -1)
    return np.cumsum(inside[:words]) > 0


def measure(text: str | None) -> dict:
    """Counts and coverage of one text."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    letters = np.frombuffer(data, np.uint8)
    points = (letters & 0xC0) != 0x80
    out = {
        "n_words": n,
        "word_chars": int(np.count_nonzero(points & ~_BLANK[letters])),
        "n_symbols": sum(data.count(bytes([s])) for s in SYMBOLS),
        "n_dup_lines": 0,
        "n_repeat_words": 0,
        "line_coverage": 0.0,
        "gram_coverage": dict.fromkeys(LIMITS, 0.0),
    }
    if not n:
        return out
    seen, repeated, total = set(), 0, 0
    for line in data.split(b"\n"):
        size = len(line.strip())
        if size:
            total += size
            if line in seen:
                out["n_dup_lines"] += 1
                repeated += size
            seen.add(line)
    out["line_coverage"] = repeated / total
    chars = np.fromiter(map(len, words), np.int64, n)
    hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    for length, keys in rolling(hashes, sorted({*LIMITS, 8})).items():
        inside = covered(keys, length, n)
        if length == 8:
            out["n_repeat_words"] = int(np.count_nonzero(inside))
        if length in LIMITS:
            out["gram_coverage"][length] = float(chars[inside].sum() / chars.sum())
    return out


def base_failed(m: dict) -> bool:
    return m["n_words"] < MIN_WORDS or 100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]


def keeps(m: dict) -> bool:
    """The verdict: base rules passed, and no coverage above its limit."""
    return (
        not base_failed(m)
        and m["line_coverage"] <= LINE_LIMIT
        and all(m["gram_coverage"][n] <= most for n, most in LIMITS.items())
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, the five counts, base_failed, kept, and the coverages behind the verdict."""

    def work(batch: pa.RecordBatch) -> dict:
        made = [measure(t) for t in batch.column(1).to_pylist()]
        return {
            key: batch.column(0),
            **{name: [m[name] for m in made] for name in COUNTS},
            "base_failed": [base_failed(m) for m in made],
            "kept": [keeps(m) for m in made],
            "line_coverage": [m["line_coverage"] for m in made],
            **{f"coverage_{n}": [m["gram_coverage"][n] for m in made] for n in LIMITS},
        }

    kind = docs.schema[key].dataType.simpleString()
    counts = ", ".join(f"{name} long" for name in COUNTS)
    shares = ", ".join(f"coverage_{n} double" for n in LIMITS)
    schema = f"{key} {kind}, {counts}, base_failed boolean, kept boolean, line_coverage double, {shares}"
    return per_batch(docs.select(F.col(key), F.col(text)), work, schema)


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` the rules keep, with all their columns."""

    def run(batches):
        for batch in batches:
            mask = [keeps(measure(t)) for t in batch.column(text).to_pylist()]
            if any(mask):
                yield batch.filter(pa.array(mask))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
