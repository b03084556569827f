"""Removal of repeated byte windows by a depth-limited radix sort of suffixes.

A suffix is ordered only through its first 50 bytes, most significant digit first, and only while its group still
holds two documents; the groups left at the full depth are exactly the windows that repeat across documents.

The first digit is chosen so that few suffixes have to travel. Of every window, the 16 bytes with the least hash (its
anchor) are a function of the window's content, so equal windows have equal anchors at equal offsets; about one
position in 17 is an anchor, and all windows with one anchor in one place lie side by side.

1. Pass one deals (anchor hash, document) by leading bits of the hash, mixed once more since the least hashes are all
   small; groups with one document are done.
2. The other anchors' stretches of text (their windows overlaid, at most 84 bytes) are dealt the same way. Equal
   stretches settle all their windows at once; of the rest, the windows are sorted by the anchor's 16 bytes and the offset,
   then by 8-byte digits to the depth of 50 bytes, dropping groups of one document after every digit.
3. Removed runs are gathered per document and cut out of its text.

A hash only chooses anchors and clears lone ones; every removal rests on equal bytes. A digit with very many rows is
thinned before it travels: of the equal anchors or stretches of a pack of documents, the smallest document's are sent.

Nulls count as empty; texts under 50 bytes lose nothing; rows with a null key are returned whole and count as no
earlier document; rows of one key never remove from each other; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, fresh, per_batch

#: Bytes of an anchor: two 8-byte digits.
ANCHOR = 16
#: Bytes of text that are worked on together, and bytes of text for each part of the first digit.
PACK = 1 << 21
PART = 1 << 23

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Low bits of a hash that give way to the place: the least hash, then the leftmost, whatever stands around.
_PLACE = np.uint64((1 << 22) - 1)
_LOW48 = np.uint64((1 << 48) - 1)


def digits(data: np.ndarray) -> np.ndarray:
    """At every place, the eight bytes that begin there as one number (zeros follow the end)."""
    wide = np.zeros(len(data) + 8, np.uint64)
    wide[: len(data)] = data
    for step, bits in ((1, 8), (2, 16), (4, 32)):
        wide = wide[:-step] | (wide[step:] << np.uint64(bits))
    return wide[: len(data)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _A
    x ^= x >> np.uint64(29)
    x *= _B
    return x ^ (x >> np.uint64(32))


def stretches(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """hash, anchor, first, last, piece: the stretches of windows that share an anchor.

    ``data`` holds pieces one after the other that end at ``ends``; no window crosses an end.
    """
    n = len(data) - length + 1
    if n < 1:
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 4)
    eight = digits(data)
    hashed = _mixed(_mixed(eight[: len(data) - ANCHOR + 1] + _B) + eight[8 : len(data) - ANCHOR + 9])
    key = (hashed & ~_PLACE) | np.arange(len(hashed), dtype=np.uint64)
    width, done = length - ANCHOR + 1, 1
    while 2 * done <= width:
        key = np.minimum(key[:-done], key[done:])
        done *= 2
    if done < width:
        key = np.minimum(key[: len(key) - (width - done)], key[width - done :])
    anchor = (key[:n] & _PLACE).astype(np.int64)
    piece = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[:n]
    inside = np.arange(length, n + length) <= ends[piece]
    changes = np.empty(n, bool)
    changes[0] = True
    changes[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    first = np.nonzero(changes)[0]
    last = np.append(first[1:], n) - 1
    good = inside[first]
    first, last = first[good], last[good]
    anchor = anchor[first]
    return hashed[anchor], anchor, first, last, piece[first]


def packed(rows: list[tuple]) -> Iterator[list[tuple]]:
    """Rows whose second field is bytes, in runs of about PACK bytes, by ascending first field."""
    run, size = [], 0
    for row in sorted(rows, key=lambda r: r[0]):
        if run and size + len(row[1]) > PACK:
            yield run
            run, size = [], 0
        run.append(row)
        size += len(row[1])
    if run:
        yield run


def _pieces(run: list[tuple], length: int):
    """The texts of a run, cut with an overlap where longer than a pack: data, ends, row of piece, offset of piece."""
    for at in [0] if len(run) > 1 else range(0, max(1, len(run[0][1])), PACK):
        texts = [r[1] for r in run] if len(run) > 1 else [run[0][1][at : at + PACK + length - 1]]
        data = np.frombuffer(b"".join(texts), np.uint8)
        yield data, np.cumsum([len(t) for t in texts]), at


def _put(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], np.int64).tobytes()
    body = head + b"".join(a.tobytes() for a in arrays)
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _get(blob: bytes, *kinds) -> list[np.ndarray]:
    body = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(body, np.int64, 1)[0])
    sizes = np.frombuffer(body, np.int64, n, 8)
    starts = 8 * (n + 1) + np.concatenate([[0], np.cumsum(sizes)])
    return [np.frombuffer(body[s:e], kind) for s, e, kind in zip(starts, starts[1:], kinds)]


def _gathered(blobs: list[bytes], *kinds) -> list[np.ndarray]:
    parts = [_get(b, *kinds) for b in blobs]
    return [np.concatenate(p) if p else np.zeros(0, k) for p, k in zip(zip(*parts), kinds)] if parts else [
        np.zeros(0, k) for k in kinds
    ]


def _split(part: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(value of ``part``, the columns' rows with it) for every value."""
    order = np.argsort(part, kind="stable")
    ordered = part[order]
    cuts = np.nonzero(np.append(True, ordered[1:] != ordered[:-1]))[0] if len(part) else []
    for start, end in zip(cuts, [*cuts[1:], len(part)]):
        yield int(ordered[start]), *[c[order[start:end]] for c in columns]


def _two(groups: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which rows belong to a group with two documents; ``groups`` ascends."""
    if not len(groups):
        return np.zeros(0, bool)
    starts = np.nonzero(np.append(True, groups[1:] != groups[:-1]))[0]
    sizes = np.diff(np.append(starts, len(groups)))
    return np.repeat(np.minimum.reduceat(docs, starts) != np.maximum.reduceat(docs, starts), sizes)


def _rows(schema: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kinds = to_arrow_schema(_parse_datatype_string(schema))
    return lambda rows: pa.Table.from_pylist([dict(zip(kinds.names, r)) for r in rows], schema=kinds)


DEALT = "part long, pack long, blob binary"


def shared_anchors(docs: DataFrame, length: int, parts: int) -> DataFrame:
    """doc_id, anchors (48 bits of each hash): the anchors a document shares with another, a few lone ones among them."""
    shift = np.uint64(64 - parts.bit_length() + 1)

    def deal(batch: pa.RecordBatch) -> dict:
        out = []
        rows = [(i, t.encode()) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        for run in packed([r for r in rows if len(r[1]) >= length]):
            ids = np.array([r[0] for r in run], np.int64)
            pack = int(_mixed(np.array([ids[0], ids[-1], len(ids)], np.int64).view(np.uint64)).sum() >> np.uint64(1))
            found, owner = [], []
            for data, ends, _ in _pieces(run, length):
                hashes, _, _, _, piece = stretches(data, ends, length)
                found.append(hashes)
                owner.append(ids[piece] if len(run) > 1 else np.full(len(piece), ids[0]))
            hashes, owner = np.concatenate(found), np.concatenate(owner)
            order = np.lexsort((owner, hashes))
            hashes, owner = hashes[order], owner[order]
            new = np.ones(len(hashes), bool)
            new[1:] = hashes[1:] != hashes[:-1]
            many = _two(hashes, owner)
            again = ~new
            again[1:] &= owner[1:] != owner[:-1]  # a further document of a group
            for part, h, d, m in _split(*[c[new] for c in (_mixed(hashes) >> shift, hashes & _LOW48, owner, many)]):
                by = np.argsort(d, kind="stable")
                out.append((part, pack, _put(h[by].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6], d[by], m[by])))
            if again.any():
                out.append((-1 - pack % parts, pack, _put(hashes[again] & _LOW48, owner[again])))
        part, pack, blob = zip(*out) if out else ((), (), ())
        return {"part": part, "pack": pack, "blob": blob}

    table = _rows(DEALT)

    def settle(key, group):
        packs, blobs = group.column("pack").to_pylist(), group.column("blob").to_pylist()
        if key[0].as_py() < 0:
            return table([(0, p, b) for p, b in zip(packs, blobs)])
        six, docs, many, own = [], [], [], []
        for i, blob in enumerate(blobs):
            h, d, m = _get(blob, np.uint8, np.int64, bool)
            wide = np.zeros((len(d), 8), np.uint8)
            wide[:, :6] = h.reshape(-1, 6)
            six.append(wide.view("<u8").ravel())
            docs.append(d)
            many.append(m)
            own.append(np.full(len(d), i))
        six, docs, many, own = map(np.concatenate, (six, docs, many, own))
        order = np.argsort(six, kind="stable")
        keep = np.zeros(len(six), bool)
        keep[order] = _two(six[order], docs[order])
        keep |= many
        return table([(0, packs[i], _put(h, d)) for i, h, d in _split(own[keep], six[keep], docs[keep])])

    by_doc = _rows("doc_id long, anchors binary")

    def per_pack(key, group):
        hashes, docs = _gathered(group.column("blob").to_pylist(), np.uint64, np.int64)
        return by_doc([(d, np.unique(h).tobytes()) for d, h in _split(docs, hashes)])

    dealt = per_batch(docs.where("doc_id is not null and text is not null").select("doc_id", "text"), deal, DEALT)
    settled = dealt.groupBy("part").applyInArrow(settle, DEALT)
    return (
        settled.groupBy("pack")
        .applyInArrow(per_pack, "doc_id long, anchors binary")
        .groupBy("doc_id")
        .agg(F.collect_list("anchors").alias("anchors"))
    )


RECORD = (np.int64, np.int64, np.int64, np.uint8, np.uint8, np.uint8)
SPAN = (np.int64, np.int64, np.int64, np.int64)


def repeated_spans(marked: DataFrame, length: int, parts: int) -> DataFrame:
    """doc_id, text_hash, spans (pairs of offsets): what is to go, from documents with their shared anchors."""
    shift = np.uint64(64 - parts.bit_length() + 1)

    def shards(spans: list[tuple]) -> list[tuple]:
        if not spans:
            return []
        d, t, s, e = np.array(spans, np.int64).T
        return [(-1 - k, 0, _put(*c)) for k, *c in _split((t ^ d) & (parts - 1), d, t, s, e)]

    def deal(batch: pa.RecordBatch) -> dict:
        out = []
        rows = [
            (i, t.encode(), h, np.frombuffer(b"".join(a), np.uint64))
            for i, t, h, a in zip(*[c.to_pylist() for c in batch.columns[:4]])
            if a and t
        ]
        # One table for all of the batch: runs come by ascending document, and larger blobs pack better.
        spans, seen = [], {}
        made: list[tuple] = []
        for run in packed(rows):
            for data, ends, at in _pieces(run, length):
                hashes, anchor, first, last, piece = stretches(data, ends, length)
                cuts = np.searchsorted(piece, np.arange(len(ends) + 1))
                starts = np.concatenate([[0], ends[:-1]])
                wanted = [
                    cuts[k] + np.nonzero(np.isin(hashes[cuts[k] : cuts[k + 1]] & _LOW48, run[k][3]))[0]
                    for k in range(len(ends))
                ]
                whole = data.tobytes()
                for k, found in enumerate(wanted):
                    doc, _, text_hash, _ = run[k]
                    base = at - int(starts[k])
                    for h, p, a, b in zip(
                        hashes[found].tolist(), anchor[found].tolist(), first[found].tolist(), last[found].tolist()
                    ):
                        stretch = whole[a : b + length]
                        owner = seen.setdefault((stretch, p - a), doc)
                        if owner < doc:
                            spans.append((doc, text_hash, base + a, base + b + length))
                        else:
                            made.append((h, doc, text_hash, base + a, p - a, stretch))
        if made:
            h, d, t, s, o, stretch = zip(*made)
            columns = [np.array(c, np.int64) for c in (d, t, s)] + [np.array(o, np.uint8)]
            part = _mixed(np.array(h, np.uint64)) >> shift
            for k, rows_, d, t, s, o in _split(part, np.arange(len(made)), *columns):
                own = [stretch[r] for r in rows_]
                sizes = np.array([len(x) for x in own], np.uint8)
                out.append((k, 0, _put(d, t, s, o, sizes, np.frombuffer(b"".join(own), np.uint8))))
        out += shards(spans)
        part, pack, blob = zip(*out) if out else ((), (), ())
        return {"part": part, "pack": pack, "blob": blob}

    table = _rows(DEALT)

    def settle(key, group):
        blobs = group.column("blob").to_pylist()
        if key[0].as_py() < 0:
            return table([(key[0].as_py(), 0, b) for b in blobs])
        docs, texts, at, offset, sizes, data = _gathered(blobs, *RECORD)
        ends = np.cumsum(sizes, dtype=np.int64)
        starts = ends - sizes
        # Equal stretches settle together: all but the smallest document's go whole.
        raw, known = data.tobytes(), {}
        form = np.fromiter(
            (known.setdefault((raw[s:e], o), len(known)) for s, e, o in zip(starts.tolist(), ends.tolist(), offset.tolist())),
            np.int64, len(docs),
        )
        least = np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(least, form, docs)
        gone = docs > least[form]
        spans = list(zip(docs[gone].tolist(), texts[gone].tolist(), at[gone].tolist(), (at + sizes)[gone].tolist()))
        # One record of every form stands for it; forms alone with their anchor are done.
        sample = np.zeros(len(known), np.int64)
        sample[form] = np.arange(len(docs))
        eight = digits(data)
        here = starts[sample] + offset[sample]
        order = np.lexsort((eight[here + 8], eight[here]))
        pair = np.stack([eight[here], eight[here + 8]])[:, order]
        new = np.append(True, (pair[:, 1:] != pair[:, :-1]).any(axis=0)) if len(order) else np.zeros(0, bool)
        gram = np.cumsum(new)
        open_ = order[_two(gram, least[order])]
        gram = gram[_two(gram, least[order])]
        # The radix sort proper: windows by (anchor, offset), then digit by digit.
        counts = sizes[sample[open_]].astype(np.int64) - length + 1
        owner = np.repeat(np.arange(len(open_)), counts)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        place = starts[sample[open_]][owner] + step
        group_ = gram[owner] * 256 + (step - offset[sample[open_]][owner].astype(np.int64) + 128)
        docs_ = least[open_][owner]
        rows = np.argsort(group_, kind="stable")
        group_ = group_[rows]
        alive = _two(group_, docs_[rows])
        rows, group_ = rows[alive], group_[alive]
        for depth in [*range(0, length - 8, 8), length - 8]:
            digit = eight[place[rows] + depth]
            order = np.lexsort((digit, group_))
            rows, digit, group_ = rows[order], digit[order], group_[order]
            new = np.ones(len(rows), bool)
            new[1:] = (digit[1:] != digit[:-1]) | (group_[1:] != group_[:-1])
            group_ = np.cumsum(new)
            alive = _two(group_, docs_[rows])
            rows, group_ = rows[alive], group_[alive]
        if len(rows):
            cuts = np.nonzero(np.append(True, group_[1:] != group_[:-1]))[0]
            first = np.repeat(np.minimum.reduceat(docs_[rows], cuts), np.diff(np.append(cuts, len(rows))))
            rows = np.sort(rows[docs_[rows] > first])
            # Neighbouring windows of one form make one run, which holds for each of the form's records that stay.
            form_of = open_[owner[rows]]
            runs: dict[int, list] = {}
            for f, s in zip(form_of.tolist(), step[rows].tolist()):
                own = runs.setdefault(f, [])
                if own and own[-1][1] == s:
                    own[-1][1] = s + 1
                else:
                    own.append([s, s + 1])
            hit = np.zeros(len(known), bool)
            hit[form_of] = True
            for r in np.nonzero(hit[form] & ~gone)[0].tolist():
                d, t, a = int(docs[r]), int(texts[r]), int(at[r])
                spans += [(d, t, a + s, a + e - 1 + length) for s, e in runs[int(form[r])]]
        return table(shards(spans))

    merged = _rows("doc_id long, text_hash long, spans binary")

    def per_shard(key, group):
        d, t, s, e = _gathered(group.column("blob").to_pylist(), *SPAN)
        order = np.lexsort((s, t, d))
        d, t, s, e = d[order], t[order], s[order], e[order]
        # Runs of overlapping or touching spans: the furthest end so far, started afresh for each document.
        fresh = np.append(True, (d[1:] != d[:-1]) | (t[1:] != t[:-1]))
        lift = np.cumsum(fresh) * (int(e.max()) + 1)
        reach = np.maximum.accumulate(e + lift)
        new = fresh.copy()
        new[1:] |= (s + lift)[1:] > reach[:-1]
        heads = np.nonzero(new)[0]
        tails = np.append(heads[1:], len(s)) - 1
        pairs = np.stack([s[heads], (reach - lift)[tails]], axis=1)
        return merged(
            [(int(d[heads[r[0]]]), int(t[heads[r[0]]]), pairs[r].tobytes()) for _, r in _split(np.cumsum(fresh)[heads], np.arange(len(heads)))]
        )

    # All columns go along: what is read of the documents is then the same for both joins, and shuffled once.
    first = ["doc_id", "text", "text_hash", "anchors"]
    dealt = per_batch(marked.select(*first, *[c for c in marked.columns if c not in first]), deal, DEALT)
    return (
        dealt.groupBy("part")
        .applyInArrow(settle, DEALT)
        .groupBy("part")
        .applyInArrow(per_shard, "doc_id long, text_hash long, spans binary")
    )


def cut(text: str | None, spans: bytes | None) -> tuple[bytes, bytes, np.ndarray]:
    """The text's bytes, what is left of them, and the removed spans."""
    data = (text or "").encode()
    pairs = np.frombuffer(spans or b"", np.int64).reshape(-1, 2)
    kept, at = [], 0
    for start, end in pairs.tolist():
        kept.append(data[at:start])
        at = end
    return data, b"".join([*kept, data[at:]]), pairs


def with_spans(docs: DataFrame, length: int = 50, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``removed_spans`` (pairs of byte offsets as 64-bit integers; null: none) beside all columns."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = 1 << max(4, (total // PART).bit_length())
    # Both joins keep all documents and have the same left side, so its shuffle is made once and read twice.
    rest = [c for c in docs.columns if c not in (text, key)]
    given = [F.struct(*rest).alias("rest")] if rest else []
    long_id = F.col(key).cast("long").alias("doc_id")
    named = docs.select(long_id, F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"), *given)
    marked = named.join(shared_anchors(named, length, parts), "doc_id", "left")
    spans = repeated_spans(marked, length, parts)
    spans = spans.groupBy("doc_id").agg(F.collect_list(F.struct("text_hash", "spans")).alias("of"))
    own = F.filter("of", lambda x: x["text_hash"] == F.col("text_hash"))
    found = named.join(spans, "doc_id", "left").withColumn("removed_spans", F.get(own, F.lit(0))["spans"])
    columns = [
        F.col("text").alias(c) if c == text else F.col("doc_id").cast(docs.schema[c].dataType).alias(c) if c == key else F.col(f"rest.{c}").alias(c)
        for c in docs.columns
    ]
    return found.select(*columns, F.col("removed_spans").alias(fresh(docs, "removed_spans")))


def deduplicated(docs: DataFrame, length: int = 50, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    marked = with_spans(docs.select(key, text), length, text, key)

    def work(batch: pa.RecordBatch) -> dict:
        rows = [cut(t, s) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        return {
            key: batch.column(0),
            "n_bytes": [len(data) for data, _, _ in rows],
            "n_removed": [len(data) - len(kept) for data, kept, _ in rows],
            "n_spans": [len(spans) for _, _, spans in rows],
            "kept_sha256": [hashlib.sha256(kept).hexdigest() for _, kept, _ in rows],
        }

    kind = docs.schema[key].dataType.simpleString()
    return per_batch(marked, work, f"{key} {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def whole_characters(data: bytes, spans: np.ndarray) -> str:
    """What is left of UTF-8 bytes when only characters that lie in a span with all their bytes go."""
    kept, at = [], 0
    for start, end in spans.tolist():
        while start < end and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        kept.append(data[at:start])
        at = end
    return b"".join([*kept, data[at:]]).decode()


def shortened_documents(docs: DataFrame, length: int = 50, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` without their repeated windows; ``n_chars``, where there is such a column, counts what is left."""
    names = docs.columns

    def run(batches):
        for batch in batches:
            texts = []
            for t, spans in zip(batch.column(text).to_pylist(), batch.columns[-1].to_pylist()):
                if spans:
                    data, _, pairs = cut(t, spans)
                    t = whole_characters(data, pairs)
                texts.append(t)
            columns = [batch.column(n) for n in names]
            columns[names.index(text)] = pa.array(texts, pa.string())
            if "n_chars" in names:
                i = names.index("n_chars")
                counts = [None if t is None else len(t) for t in texts]
                columns[i] = pa.array(counts, pa.int64()).cast(columns[i].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    marked = with_spans(docs, length, text, key)
    bounded_batches(docs.sparkSession)
    return marked.mapInArrow(run, docs.schema)
