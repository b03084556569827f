"""Operators on single texts against the library or brute force."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import documents, texts
from tidemark.llm import bpe, repetition, tokencount

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [" ", "  ", "\n", "\t", "a", "Bc", "é", "1", "'s", "'", "!", " ", "<|endoftext|>", "中", "😀", "\r", "\x1c", "\x85", "　"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(5)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(3000)]


def test_counts_equal_the_library(library):
    made = odd_texts() + [t or "" for _, t in texts()]
    want = [len(e) for e in library.encode_batch(made, add_special_tokens=False)]
    assert tokencount.count_tokens(made, PATH) == want


def test_safe_pieces_give_the_text_back():
    for text in odd_texts():
        assert "".join(tokencount.safe_pieces(text)) == text


def test_counts_with_small_memory(library, monkeypatch):
    monkeypatch.setattr(tokencount, "REMEMBERED", 10)
    made = odd_texts()[:200]
    assert tokencount.count_tokens(made, PATH) == [len(e) for e in library.encode_batch(made, add_special_tokens=False)]


def test_sentencepiece_counts():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    made = odd_texts()[:100]
    assert tokencount.count_tokens(made, path) == [len(i) for i in model.encode(made)]


def test_token_count_table(spark, library):
    rows = tokencount.token_counts(documents(spark), PATH).collect()
    want = sorted(
        ((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t in texts()), key=repr
    )
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in rows), key=repr) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows)
    assert tokencount.token_counts(documents(spark, []), PATH).collect() == []


def test_bpe_equals_the_library(library):
    coder = bpe.Codec(PATH)
    for text in odd_texts() + [t or "" for _, t in texts()]:
        want = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == want
        assert coder.decode(want) == library.decode(want, skip_special_tokens=False) == text


def test_merges_skip_stale_entries():
    ranks = {(1, 2): (0, 4), (2, 3): (1, 5), (4, 3): (2, 6)}
    assert bpe.merge_symbols([1, 2, 3, 1, 2, 2, 3], ranks) == [6, 4, 5]
    assert bpe.merge_symbols([], ranks) == [] and bpe.merge_symbols([3], ranks) == [3]


def test_overlapping_equal_pairs():
    assert bpe.merge_symbols([1] * 5, {(1, 1): (0, 2), (2, 2): (1, 3)}) == [3, 1]


def test_bpe_tables(spark, library):
    docs = documents(spark)
    want = []
    for i, t in texts():
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = hashlib.sha256
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()).hexdigest(), sha((t or "").encode()).hexdigest()))
    made = [tuple(r) for r in bpe.round_trip(docs, PATH).collect()]
    assert sorted(made, key=repr) == sorted(want, key=repr)
    encoded = bpe.encoded_documents(docs, PATH)
    assert sorted(map(tuple, encoded.drop("ids").collect()), key=repr) == sorted(want, key=repr)
    back = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted(map(tuple, back), key=repr) == sorted(((i, t or "") for i, t in texts()), key=repr)
    assert bpe.round_trip(documents(spark, []), PATH).collect() == []


def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, again, len(inside)


def share(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    inside = {j for i in range(len(words) - n + 1) if runs[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}
    return sum(len(words[j].encode()) for j in inside) / max(1, sum(len(w.encode()) for w in words))


def test_repetition_equals_brute_force(spark):
    rng = random.Random(3)
    more = [(100 + k, " ".join(rng.choices(["a", "bb", "#c", "é", "d\n"], k=rng.randint(0, 40)))) for k in range(150)]
    rows = repetition.quality(documents(spark, texts() + more), ).collect()
    given = sorted(texts() + more, key=repr)
    by_text = {}
    for i, t in given:
        by_text[i, counted(t)] = t
    for r in rows:
        key = r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        text = by_text[key]
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed
        for n in repetition.LIMITS:
            assert abs(r[f"coverage_{n}"] - share(text, n)) < 1e-12
        over = any(share(text, n) > most for n, most in repetition.LIMITS.items()) or r.line_coverage > repetition.LINE_LIMIT
        assert r.kept == (not failed and not over)
    assert len(rows) == len(given)
    assert repetition.quality(documents(spark, [])).collect() == []


def test_quality_stage_keeps_rows_whole(spark):
    docs = documents(spark)
    kept = repetition.kept_documents(docs)
    assert kept.columns == docs.columns
    want = [(i, t) for i, t in texts() if repetition.keeps(repetition.measure(t))]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert {1, 13} <= {i for i, _ in want} and 11 not in {i for i, _ in want}
