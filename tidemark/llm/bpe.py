"""BPE encoding and decoding of byte-level vocabularies.

Encoding follows the merge ranks with a priority queue over a doubly linked list of symbols: every adjacent
pair that has a rank is queued as (rank, place); the least is taken off, skipped when the pair at that place is
no longer the queued one, else merged, and the two new neighbours are queued. A piece of n symbols costs
O(n log n), so one word of a million letters is no danger. Decoding concatenates vocabulary strings.

Texts are cut into pieces first: at special strings, then at the safe places of ``tokencount.safe_pieces``, then
by the vocabulary's pattern. The ids of pieces are remembered in each worker up to a fixed number of entries.

Nulls encode as empty texts (no ids); empty tables give empty results; repeated rows are encoded row by row;
columns beside the key and the text are ignored. Bytes that are no valid UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keeps, per_batch
from tidemark.llm.tokencount import safe_pieces

#: Fixed value: the pattern of byte-level BPE vocabularies of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

REMEMBERED = 250_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def merge_symbols(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Symbols after all merges. ``ranks``: pair of ids -> (rank, id of the merged symbol)."""
    n = len(symbols)
    if n < 2:
        return symbols
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    queue = []
    for i in range(n - 1):
        found = ranks.get((symbols[i], symbols[i + 1]))
        if found:
            queue.append((found[0], i, found[1]))
    heapify(queue)
    while queue:
        rank, i, merged = heappop(queue)
        j = right[i]
        if symbols[i] < 0 or j >= n or ranks.get((symbols[i], symbols[j])) != (rank, merged):
            continue  # stale: one of the two has been merged since
        symbols[i], symbols[j] = merged, -1
        after = right[i] = right[j]
        if after < n:
            left[after] = i
            found = ranks.get((merged, symbols[after]))
            if found:
                heappush(queue, (found[0], i, found[1]))
        before = left[i]
        if before >= 0:
            found = ranks.get((symbols[before], merged))
            if found:
                heappush(queue, (found[0], before, found[1]))
    return [s for s in symbols if s >= 0]


class Remembered:
    """A dictionary of two generations: when the young one is full, the old one goes."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value):
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Codec:
    """A byte-level BPE vocabulary, read from a tokenizer file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        vocabulary = stored["model"]["vocab"]
        letters = byte_letters()
        back = {letter: byte for byte, letter in enumerate(letters)}
        self.of_byte = [vocabulary[letter] for letter in letters]
        self.ranks = {}
        for rank, merge in enumerate(stored["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[vocabulary[a], vocabulary[b]] = rank, vocabulary[a + b]
        self.strings = {i: bytes(back[c] for c in s) for s, i in vocabulary.items() if all(c in back for c in s)}
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        self.parts = re.compile("|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) or r"(?!)")
        self.pattern = regex.compile(PATTERN).findall
        self.known = Remembered(REMEMBERED)

    def words(self, piece: str) -> list[str]:
        """The piece cut by the vocabulary's pattern; plain words need no regular expression."""
        if piece[0] == " " or piece[0].isalpha():
            if piece[1:].isalpha():
                return [piece]
            if piece[-1] in ".,;:!?" and piece[1:-1].isalpha():
                return [piece[:-1], piece[-1]]
        return self.pattern(piece)

    def word(self, word: str) -> tuple[str, bytes]:
        """Ids of a word as text, and the bytes they decode to."""
        found = self.known.get(word)
        if found is None:
            ids = merge_symbols([self.of_byte[b] for b in word.encode()], self.ranks)
            found = ",".join(map(str, ids)), b"".join(map(self.strings.__getitem__, ids))
            if len(word) < 64:
                self.known.put(word, found)
        return found

    def coded(self, text: str) -> tuple[str, bytes]:
        """The ids of a text in decimal joined by commas, and the bytes they decode to."""
        if not text:
            return "", b""
        out: list[tuple[str, bytes]] = []
        add, known, word, special = out.append, self.known, self.word, self.special
        young = known.young.get
        for piece in self.pieces(text):
            found = young(piece)
            if found is not None:
                add(found)
            elif piece in special:
                add((str(special[piece]), piece.encode()))
            else:
                # A known word before a mark is that word and the mark: the pattern goes from neither into the other.
                if piece[-1] in ".,;:!?" and piece[-2:-1].isalnum() and (found := young(piece[:-1])) is not None:
                    add(found)
                    add(word(piece[-1]))
                else:
                    out.extend(map(word, self.words(piece)))
                young = known.young.get
        written, decoded = zip(*out)
        return ",".join(written), b"".join(decoded)

    def pieces(self, text: str) -> list[str]:
        """Pieces that encode independently of each other; joining gives the text back."""
        if not any(s in text for s in self.special):
            return safe_pieces(text)
        out, at = [], 0
        for found in self.parts.finditer(text):
            out += [*safe_pieces(text[at : found.start()]), found.group()]
            at = found.end()
        return out + safe_pieces(text[at:])

    def encode(self, text: str) -> list[int]:
        return _numbers(self.coded(text)[0])

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def _numbers(written: str) -> list[int]:
    return list(map(int, written.split(","))) if written else []


def _digests(written: str, decoded: bytes) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the ids in decimal joined by commas, SHA-256 of the decoded text."""
    n = written.count(",") + 1 if written else 0
    text = decoded.decode("utf-8", "replace").encode()
    return n, hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(text).hexdigest()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


keeps(__name__, codec.cache_clear)


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, ids: the token ids of each text."""

    def work(batch: pa.RecordBatch) -> dict:
        coder = codec(path)
        return {key: batch.column(0), "ids": [coder.encode(t or "") for t in batch.column(1).to_pylist()]}

    kind = docs.schema[key].dataType.simpleString()
    return per_batch(docs.select(F.col(key), F.col(text)), work, f"{key} {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """key, text: the text of each list of ids, special tokens included (null ids: empty)."""

    def work(batch: pa.RecordBatch) -> dict:
        coder = codec(path)
        return {key: batch.column(0), "text": [coder.decode(i or []) for i in batch.column(1).to_pylist()]}

    kind = encoded.schema[key].dataType.simpleString()
    return per_batch(encoded.select(F.col(key), F.col(ids)), work, f"{key} {kind}, text string")


def round_trip(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256: each text encoded, its ids decoded, both digested."""

    def work(batch: pa.RecordBatch) -> dict:
        coder = codec(path)
        made = [_digests(*coder.coded(t or "")) for t in batch.column(1).to_pylist()]
        counts, ids, decoded = zip(*made)
        return {key: batch.column(0), "n_tokens": counts, "ids_sha256": ids, "decoded_sha256": decoded}

    kind = docs.schema[key].dataType.simpleString()
    return per_batch(
        docs.select(F.col(key), F.col(text)),
        work,
        f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


def encoded_documents(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, ids, n_tokens, ids_sha256, decoded_sha256: the ids of each text beside the digests of ``round_trip``."""

    def work(batch: pa.RecordBatch) -> dict:
        coder = codec(path)
        offsets, ids, made = [0], [], []
        for t in batch.column(1).to_pylist():
            written, decoded = coder.coded(t or "")
            made.append(_digests(written, decoded))
            ids.append(np.array(_numbers(written), np.int32))
            offsets.append(offsets[-1] + len(ids[-1]))
        counts, of_ids, of_text = zip(*made)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids)))
        return {
            key: batch.column(0), "ids": lists, "n_tokens": counts, "ids_sha256": of_ids, "decoded_sha256": of_text
        }

    kind = docs.schema[key].dataType.simpleString()
    return per_batch(
        docs.select(F.col(key), F.col(text)),
        work,
        f"{key} {kind}, ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
