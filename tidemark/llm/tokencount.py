"""Token counts: batch encoding in Arrow functions that return lengths only.

The library spends about a second on each megabyte, most of it on pieces it has met before. A text is
therefore cut at safe boundaries (between two non-blank characters, before the single space that joins
them: no token of the vocabulary's pattern crosses such a place, and what follows does not depend on what
stood before), the library encodes each distinct piece once, and a text's count is the sum over its pieces.
Pieces go to the library in batches of about equal bytes; a very long text is thus split like any other.

Nulls count as empty texts (0 tokens); empty tables give empty results; repeated rows and ties in doc_id are
counted row by row; columns beside ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_batch

#: A blank that is no single space between two non-blank characters.
_ODD = re.compile(r"[^\S ]\s|  |\s[^\S ]|^ | $")
_SAFE = re.compile(r"(?<=\S)(?= \S)")

#: Distinct pieces a worker remembers; more are encoded again, the counts do not change.
REMEMBERED = 600_000
BATCH_BYTES = 1 << 18


def safe_pieces(text: str) -> list[str]:
    """The text cut before every single space that joins two non-blank characters; joining gives it back."""
    if _ODD.search(text):
        return _SAFE.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + piece for piece in rest]] if text else []


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    """The library's tokenizer and the counts remembered with it, once per Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)], None, []
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    specials = sorted((t.content for t in model.get_added_tokens_decoder().values()), key=len, reverse=True)
    return (
        lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)],
        {},
        specials,
    )


def _balanced(texts: list[str], most: int = BATCH_BYTES):
    """Runs of texts of about ``most`` characters; a longer text stands alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield texts[start:]


def count_tokens(texts: list[str], path: str, splits: bool = True) -> list[int]:
    """Token count of each text. ``splits``: the vocabulary cuts before spaces (byte-level BPE does)."""
    encode, known, specials = _tokenizer(path)
    if known is None or not splits:
        return [n for run in _balanced(texts) for n in encode(run)]
    # A special string inside a text is one token and parts the text: it is looked for first.
    whole = re.compile("|".join(map(re.escape, specials))) if specials else None
    counts = []
    for group in _balanced(texts, 16 * BATCH_BYTES):
        pieces = []
        for text in group:
            own: list[str] = []
            at = 0
            for found in whole.finditer(text) if whole and any(s in text for s in specials) else ():
                own += safe_pieces(text[at : found.start()])
                own.append(found.group())
                at = found.end()
            own += safe_pieces(text[at:] if at else text)
            pieces.append(own)
        distinct = set(chain.from_iterable(pieces))
        fresh = list(distinct - known.keys())
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
            fresh = list(distinct)
        for run in _balanced(fresh):
            known.update(zip(run, encode(run)))
        counts += [sum(map(known.__getitem__, own)) for own in pieces]
    return counts


def token_counts(docs: DataFrame, path: str, limit: int = 512, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit); one row per row of ``docs``."""

    def work(batch: pa.RecordBatch) -> dict:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        counts = np.array(count_tokens(texts, path), np.int64)
        return {
            key: batch.column(0),
            "n_bytes": [len(t.encode()) for t in texts],
            "n_tokens": counts,
            "over_limit": counts > limit,
        }

    kind = docs.schema[key].dataType.simpleString()
    return per_batch(
        docs.select(F.col(key), F.col(text)), work, f"{key} {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
