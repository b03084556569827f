"""Near and exact duplicates against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import documents, prose, texts
from tidemark.llm import gridjoin, simhash, suffixes
from tidemark.llm.components import components


def united(ids, linked):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    loose = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    edges = [*chain, *star, *loose, (7, 7), (600, 601), (601, 600)]
    made = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = united({i for e in edges for i in e}, edges)
    assert made == {i: c for i, c in want.items() if i in made} and 7 not in made
    assert {i for i in want if i not in made} <= {7} | {a for a, b in loose if a == b}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_brute_force(monkeypatch):
    for slab in (simhash.SLAB, 7):
        monkeypatch.setattr(simhash, "SLAB", slab)
        for _, text in texts():
            if len(text or "") < 10_000:
                assert simhash.fingerprint(text) == fingerprint(text)


def test_spark_hash_is_the_shingle_hash(spark):
    value = spark.range(1).selectExpr("xxhash64('a b c') AS h").first()[0] % (1 << 64)
    assert value == xxhash.xxh64_intdigest(b"a b c", 42)


def near_prints(spark, prints, chunk):
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(frame, 3, chunk).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    return united(prints, edges)


@pytest.mark.parametrize("chunk", [2000, 4])
def test_links_lose_nothing(spark, chunk):
    rng = random.Random(2)
    prints = {0, (1 << 64) - 1}
    for _ in range(25):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            changed = base
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                changed ^= 1 << bit
            prints.add(changed)
    prints = sorted(prints)
    want = united(prints, [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3])
    assert near_prints(spark, prints, chunk) == want


def test_near_duplicates(spark):
    rows = simhash.near_duplicates(documents(spark)).collect()
    assert len(rows) == len(texts())
    prints = {}
    for i, t in texts():
        prints.setdefault(simhash.fingerprint(t), []).append(i)
    keys = sorted(prints)
    found = united(keys, [(a, b) for a in keys for b in keys if a < b and (a ^ b).bit_count() <= 3])
    least = {}
    for p, c in found.items():
        least[c] = min([*[i for i in prints[p] if i is not None], least.get(c, 1 << 62)])
    for r in rows:
        assert r.component_id == least[found[int(r.fingerprint, 16)]] and len(r.fingerprint) == 16
    assert {r.component_id for r in rows if r.doc_id in (6, 7, 8)} == {6}
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = simhash.kept_documents(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(11) == 1 and ids.count(None) == 2 and ids.count(1) == 1
    assert not {2, 3, 7, 8} & set(ids) and {4, 5, 6, 9, 10, 12, 13} <= set(ids)


def test_rows_that_share_a_key_or_have_none_are_compared(spark):
    base, far, third = prose(21, 50), prose(22, 50), prose(23, 50)
    rows = [(1, base), (1, base.upper()), (5, third), (5, base), (None, far), (None, far.upper()), (None, far)]
    kept = [(r.doc_id, r.text.lower()) for r in simhash.kept_documents(documents(spark, rows)).collect()]
    assert sorted(kept, key=repr) == sorted([(1, base), (5, third), (None, far)], key=repr)


def cut_by_brute_force(rows, length=50):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        data = (t or "").encode()
        for s in range(len(data) - length + 1):
            first.setdefault(data[s : s + length], i)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        if i is not None:
            for s in range(len(data) - length + 1):
                if first[data[s : s + length]] < i:
                    gone[s : s + length] = b"\1" * length
        spans = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def spliced():
    """Texts made of shared passages of many lengths around the threshold, at odd places."""
    rng = random.Random(9)
    passages = [prose(50 + k, 30)[: rng.randint(44, 120)] for k in range(12)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages)[rng.randint(0, 8) :] if rng.random() < 0.6 else prose(rng.random(), 6) for _ in range(6)]
        rows.append((rng.randint(0, 40), "ü".join(parts)))
    return rows + texts() + [(70, "ab" * 300), (71, "ab" * 100), (72, "ab" * 25), (73, "ab" * 24)]


@pytest.mark.parametrize("pack", [suffixes.PACK, 3000])
def test_suffixes_equal_brute_force(spark, monkeypatch, pack):
    monkeypatch.setattr(suffixes, "PACK", pack)
    rows = [(i, t) for i, t in spliced() if len(t or "") < 10_000]
    made = sorted(map(tuple, suffixes.deduplicated(documents(spark, rows)).collect()), key=repr)
    assert made == cut_by_brute_force(rows)


def test_suffixes_of_no_rows(spark):
    assert suffixes.deduplicated(documents(spark, [])).collect() == []


def test_long_texts_in_pieces():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 123, 3000, dtype=np.uint8)
    whole = suffixes.stretches(data, np.array([3000]), 50)
    starts = {s for a, b in zip(whole[2], whole[3]) for s in range(a, b + 1)}
    assert starts == set(range(2951))
    copy = suffixes.stretches(data[1000:2000], np.array([1000]), 50)
    anchors = {(s + 1000, p + 1000) for p, a, b in zip(*copy[1:4]) for s in range(a, b + 1)}
    assert anchors <= {(s, p) for p, a, b in zip(*whole[1:4]) for s in range(a, b + 1)}


def test_shortened_texts_stay_valid(spark):
    shared = "é" * 40
    rows = [(1, "a" + shared), (2, "bc" + shared + "d"), (3, None), (4, "x")]
    docs = documents(spark, rows)
    made = suffixes.shortened_documents(docs)
    assert made.columns == docs.columns
    found = {r.doc_id: (r.text, r.n_chars, r.removed_spans) for r in made.collect()}
    assert found == {1: ("a" + shared, 41, "s"), 2: ("bcd", 3, "s"), 3: (None, None, "s"), 4: ("x", 1, "s")}
    assert suffixes.whole_characters("aéb".encode(), np.array([[2, 3]])) == "aéb"
    assert suffixes.whole_characters("aéb".encode(), np.array([[1, 3]])) == "ab"


def vectors():
    rng = np.random.default_rng(6)
    rows, n = [], 0
    for label in (1, 2, None):
        for _ in range(12):
            base = rng.normal(size=8)
            for _ in range(rng.integers(1, 6)):
                rows.append((n, (base + rng.normal(size=8) * rng.choice([0.02, 0.1, 0.2])).astype(np.float32).tolist(), label))
                n += 1
    copy = rows[0][1]
    rows += [(n + k, copy, 1) for k in range(5)] + [(n + 5, copy, 2), (n + 6, [2 * x for x in copy], 1)]
    bad = [None, [], [0.0] * 8, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, copy[:7], [1.0]]
    return rows + [(n + 10 + k, v, 1) for k, v in enumerate(bad)]


def vector_links(rows, least=0.98):
    def sound(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    linked = []
    for a, (i, v, k) in enumerate(rows):
        for j, w, m in rows[:a]:
            if k == m and k is not None and sound(v) and sound(w) and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    linked.append((j, i))
    return linked


@pytest.mark.parametrize("block,leaf", [(512, 64), (4, 2)])
def test_vectors_equal_brute_force(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(gridjoin, "BLOCK", block)
    monkeypatch.setattr(gridjoin, "LEAF", leaf)
    rows = vectors()
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, node long, times long")
    made = sorted(map(tuple, gridjoin.near_vectors(frame).collect()))
    linked = vector_links(rows)
    group = united([r[0] for r in rows], linked)
    want = [(i, sum(i in e for e in linked), group[i], group[i] == i) for i, _, _ in rows]
    assert made == sorted(want)


def test_vectors_of_no_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert gridjoin.near_vectors(spark.createDataFrame([], schema)).collect() == []
    only = gridjoin.near_vectors(spark.createDataFrame([(3, None, 1), (None, [1.0], 1)], schema)).collect()
    assert sorted(map(tuple, only), key=repr) == [(3, 0, 3, True), (None, 0, None, True)]
