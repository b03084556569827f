"""How the sources of each language differ in their terms, by iceberg prefix refinement.

Which terms are frequent is found without counting all terms. First the documents of every short byte prefix are
counted; prefixes below the threshold are discarded with all terms under them. What remains is extended, twice as long
each time, and counted again, until all that remains are complete terms. Only those are counted per source.

Documents stay where they are: a task counts the documents of a prefix in a batch of texts, and only these sums are
shuffled. The next level learns which prefixes remain from a bitmap of fixed size, so a task may try a prefix too many,
never one too few; the counts themselves decide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, looked_up, numbered_values, per_batch, stored, words_of

#: Bytes of the shortest prefix; each level doubles it.
FIRST_PREFIX = 6
#: Bits of the bitmap of prefixes that remain (4 MB), sent to every task.
BITMAP = 1 << 25
#: Pairs of sources compared at a time in a task.
PAIRS = 1 << 18
#: Rows a task gathers before it adds up what is alike and hands it on.
GATHERED = 1 << 18
#: Groups (language and source) up to which their totals are sent to every task.
GROUPS = 100_000

#: Bytes of terms: letters A-Z, a-z and all of non-ASCII characters.
_IN_TERM = bytes(b >= 0x80 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256))


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of a batch of texts, as bytes, and the row each is in."""
    return words_of(texts, _IN_TERM)


def _listed(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The same from a column of lists of terms."""
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return lists.flatten().cast(pa.large_binary()), np.repeat(np.arange(len(lists)), lengths)


def _in_bitmap(bitmap: bytes, langs: pa.Array, lang: np.ndarray, terms: pa.Array) -> np.ndarray:
    """Whether the hash of (language, term) is set, for numbered languages; hashed as Spark's ``xxhash64`` does."""
    seeds = [xxhash.xxh64_intdigest(x, 42) for x in langs.to_pylist()]
    digest = xxhash.xxh64_intdigest
    hashes = (digest(t, seeds[i]) for t, i in zip(terms.to_pylist(), lang.tolist()))
    bits = np.fromiter((h & (BITMAP - 1) for h in hashes), np.int64, len(terms))
    return (np.frombuffer(bitmap, np.uint8)[bits >> 3] >> (bits & 7) & 1).astype(bool)


def bitmap_of(remaining: DataFrame, term: str) -> bytes:
    """The bitmap of the rows' (lang, term) hashes; what reaches the driver is never larger than the bitmap."""
    bit = F.xxhash64("lang", term).bitwiseAND(F.lit(BITMAP - 1))
    words = remaining.select(F.shiftright(bit, 6).alias("word"), F.expr("1L").alias("one"), bit.alias("bit"))
    mask = F.expr("shiftleft(one, cast(bit & 63 as int))")
    found = words.groupBy("word").agg(F.bit_or(mask).alias("mask")).toArrow()
    out = np.zeros(BITMAP // 64, np.int64)
    out[found.column("word").to_numpy()] = found.column("mask").to_numpy()
    return out.tobytes()


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _numbered(values: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and each value's place among them; by a table where ``below`` is not too large for one."""
    if below > 8 * len(values) + (1 << 20):
        return np.unique(values, return_inverse=True)
    there = np.zeros(below, bool)
    there[values] = True
    found = np.flatnonzero(there)
    place = np.zeros(below, np.int32)
    place[found] = np.arange(len(found))
    return found, place[values].astype(np.int64)


Reader = Callable[[pa.Array], tuple[pa.Array, np.ndarray]]


def _distinct_terms(batch: pa.RecordBatch, read: Reader) -> tuple:
    """Distinct (language, term) of a batch: numbers of languages, terms, then for each occurrence its row and number."""
    terms, row = read(batch.column("content"))
    lang, langs = numbered_values(batch.column("lang"))
    term, names = numbered_values(terms)
    pair, which = _numbered(lang[row] * max(1, len(names)) + term, len(langs) * max(1, len(names)))
    lang_of, term_of = np.divmod(pair, max(1, len(names)))
    return langs, lang_of, names.take(pa.array(term_of)), row, which


def _prefix_counts(read: Reader, length: int) -> Callable[[pa.RecordBatch], dict]:
    """lang, prefix, complete, docs: in how many rows of a batch a term has this prefix, or is it and complete."""

    def count(batch: pa.RecordBatch) -> dict:
        langs, lang_of, terms, row, which = _distinct_terms(batch, read)
        long = pc.greater(pc.binary_length(terms), length).to_numpy(zero_copy_only=False)
        cut, prefixes = numbered_values(pc.binary_slice(terms, 0, length))
        key = (lang_of * max(1, len(prefixes)) + cut) * 2 + long
        keys, of_term = np.unique(key, return_inverse=True)
        seen = _distinct(row * max(1, len(keys)) + of_term[which])
        docs = np.bincount(seen % max(1, len(keys)), minlength=len(keys))
        lang, cut = np.divmod(keys >> 1, max(1, len(prefixes)))
        return {
            "lang": langs.take(pa.array(lang)), "prefix": prefixes.take(pa.array(cut)).cast(pa.binary()),
            "complete": keys & 1 == 0, "docs": docs,
        }

    return count


def _longer_terms(read: Reader, length: int, remain) -> Callable[[pa.RecordBatch], dict]:
    """lang, content: the distinct terms of every row that are longer than a prefix which remains."""

    def narrow(batch: pa.RecordBatch) -> dict:
        langs, lang_of, terms, row, which = _distinct_terms(batch, read)
        open_ = pc.greater(pc.binary_length(terms), length).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(open_)
        prefixes = pc.binary_slice(terms.take(pa.array(at)), 0, length)
        open_[at] = _in_bitmap(remain.value, langs, lang_of[at], prefixes)
        seen = _distinct((row * max(1, len(terms)) + which)[open_[which]])
        row, term = np.divmod(seen, max(1, len(terms)))
        rows, starts = np.unique(row, return_index=True)
        offsets = pa.array(np.append(starts, len(row)).astype(np.int32))
        content = pa.ListArray.from_arrays(offsets, terms.take(pa.array(term)).cast(pa.binary()))
        return {"lang": batch.column("lang").take(pa.array(rows)), "content": content}

    return narrow


def frequent_terms(docs: DataFrame, least: int = 3) -> DataFrame:
    """lang, term (bytes), docs: the terms in at least ``least`` rows of a language, of rows lang, content (the text).

    A level's prefixes are at most as many as the distinct prefixes of that length; the texts are read twice (all
    prefixes are counted, longer terms under remaining ones are put aside), later levels read what was put aside.
    """
    spark = docs.sparkSession
    length, read, rows, complete = FIRST_PREFIX, terms_of, docs, None
    while True:
        found = per_batch(rows, _prefix_counts(read, length), "lang string, prefix binary, complete boolean, docs long")
        counted = found.groupBy("lang", "prefix", "complete").agg(F.sum("docs").alias("docs"))
        level = stored(counted.where(F.col("docs") >= least), "prefixes")
        whole = level.where("complete").select("lang", F.col("prefix").alias("term"), "docs")
        complete = whole if complete is None else complete.union(whole)
        remaining = level.where("not complete")
        if remaining.isEmpty():
            return complete
        bitmap = spark.sparkContext.broadcast(bitmap_of(remaining, "prefix"))
        rows = stored(per_batch(rows, _longer_terms(read, length, bitmap), "lang string, content array<binary>"), "longer")
        length, read = 2 * length, _listed


def _occurrences(kept) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """lang, term, sources, n: per language and term whose bit is set, its sources and their occurrences in a task.

    A task adds up what it has gathered when that is much, so a frequent term leaves it in few rows.
    """

    def counted(batch: pa.RecordBatch) -> pa.Table:
        langs, lang_of, terms, row, which = _distinct_terms(batch, terms_of)
        good = _in_bitmap(kept.value, langs, lang_of, terms)
        source, sources = numbered_values(batch.column("source"))
        use = good[which]
        keys = np.sort(which[use] * max(1, len(sources)) + source[row[use]])
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        n = np.diff(np.append(starts, len(keys)))
        which, source = np.divmod(keys[starts], max(1, len(sources)))
        return pa.table({
            "lang": langs.take(pa.array(lang_of[which])), "source": sources.take(pa.array(source)),
            "term": terms.take(pa.array(which)), "n": n,
        })

    def added_up(parts: list[pa.Table]) -> pa.RecordBatch:
        rows = pa.concat_tables(parts).combine_chunks()
        (lang, langs), (source, sources), (term, terms) = (
            numbered_values(rows.column(c).combine_chunks() if rows.num_rows else rows.column(c)) for c in ("lang", "source", "term")
        )
        key = (lang * max(1, len(terms)) + term) * max(1, len(sources)) + source
        order = np.argsort(key, kind="stable")
        key, n = key[order], rows.column("n").to_numpy()[order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        n, key = np.add.reduceat(n, starts), key[starts]
        pair, source = np.divmod(key, max(1, len(sources)))
        firsts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        offsets = pa.array(np.append(firsts, len(pair)).astype(np.int32))
        lang, term = np.divmod(pair[firsts], max(1, len(terms)))
        return pa.RecordBatch.from_pydict({
            "lang": langs.take(pa.array(lang)), "term": terms.take(pa.array(term)).cast(pa.binary()),
            "sources": pa.ListArray.from_arrays(offsets, sources.take(pa.array(source))),
            "n": pa.ListArray.from_arrays(offsets, pa.array(n)),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for batch in batches:
            part = counted(batch) if batch.num_rows else None
            if part is None or not part.num_rows:
                continue
            parts.append(part)
            rows += part.num_rows
            del part
            if rows >= GATHERED:
                yield added_up(parts)
                parts, rows = [], 0
                pa.default_memory_pool().release_unused()
        if parts:
            yield added_up(parts)
        pa.default_memory_pool().release_unused()

    return run


def term_counts(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, term, n, sources, ns: every kept term's occurrences, in all and by source, of lang, source, content.

    Tasks send a term once; all that follows keeps to the terms' partitions. A term's list has its sources.
    """
    bounded_batches(docs.sparkSession)
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(kept, "term"))
    made = "lang string, term binary, sources array<string>, n array<bigint>"
    rows = docs.mapInArrow(_occurrences(bitmap), made).repartition("lang", "term")
    flat = rows.select("lang", "term", F.explode(F.arrays_zip("sources", "n")).alias("e"))
    each = flat.groupBy("lang", "term", F.col("e.sources").alias("source")).agg(F.sum("e.n").alias("n"))
    lists = F.collect_list(F.struct("source", "n")).alias("of")
    terms = each.groupBy("lang", "term").agg(F.sum("n").alias("n"), lists)
    exact = terms.join(kept.select("lang", "term"), ["lang", "term"], "left_semi")
    return exact.select("lang", "term", "n", F.col("of.source").alias("sources"), F.col("of.n").alias("ns"))


def _share(n: Column, total: str, kept: str) -> Column:
    """1 + floor(1000000000 * (n + 1) / (total + 1 * kept)), in whole numbers."""
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    n = (n.cast("decimal(20,0)") + 1).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.try_divide(n - n % (wide(total) + wide(kept)), wide(total) + wide(kept)).cast("long") + 1


def shares_of(n: np.ndarray, of: np.ndarray) -> np.ndarray:
    """1 + floor(1000000000 * (n + 1) / of) of int64 arrays, n + 1 <= of < 2**53: long division, three digits a step."""
    rest, out = n + 1, np.zeros(len(n), np.int64)
    whole, rest = np.divmod(rest, of)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, of)
        out = out * 1000 + digit
    return out + whole * 1_000_000_000 + 1


def _apart(p: str, q: str) -> Column:
    """floor((p - q) * (p - q) / q)"""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _squares(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class _Sums:
    """What a task finds of its terms, added up: amounts of pairs, numbers of terms by share, and leading terms."""

    def __init__(self, top: int):
        self.top = top
        self.pairs: dict[str, list] = {}
        self.levels: list[np.ndarray] = []
        self.leading: list[pa.Table] = []

    def add_pairs(self, lang: str, place: np.ndarray, p: np.ndarray, none: np.ndarray, sizes: np.ndarray) -> None:
        """What every two sources of a term that both have it add to the sums made as if only one had it."""
        span = int(place.max()) + 1
        if lang not in self.pairs or len(self.pairs[lang][0]) < span:
            grown = [np.zeros((span, span), np.int64) for _ in range(2)]
            for new, old in zip(grown, self.pairs.get(lang, [])):
                new[: len(old), : len(old)] = old
            self.pairs[lang] = grown
        high, low = self.pairs[lang]
        partners = np.repeat(sizes, sizes)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        done, at = np.cumsum(partners), 0
        while at < len(p):  # every element meets all of its own list: a block of elements at a time
            end = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + PAIRS, "right")))
            m = partners[at:end]
            a = np.repeat(np.arange(at, end), m)
            b = np.arange(len(a)) - np.repeat(np.cumsum(m) - m, m) + np.repeat(first[at:end], m)
            a, b = a[a != b], b[a != b]
            more = _squares(p[a], p[b]) - _squares(p[a], none[b]) - _squares(none[a], p[b]) + _squares(none[a], none[b])
            cell = place[a] * len(high) + place[b]
            np.add.at(high.reshape(-1), cell, more >> 32)
            np.add.at(low.reshape(-1), cell, more & 0xFFFFFFFF)
            at = end

    def add_levels(self, group: np.ndarray, p: np.ndarray, terms: np.ndarray | int = 1) -> None:
        rows = np.stack([group, p, np.broadcast_to(terms, p.shape)], 1)
        rows = rows[np.lexsort((p, group))]
        starts = np.flatnonzero(np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))
        rows[starts, 2] = np.add.reduceat(rows[:, 2], starts)
        self.levels.append(rows[starts])

    def add_leading(self, group: np.ndarray, term: pa.Array, value: np.ndarray) -> None:
        self.leading.append(pa.table({"group": group, "term": term, "value": value}))
        self.leading = [self._led()] if sum(t.num_rows for t in self.leading) > GATHERED else self.leading

    def _led(self) -> pa.Table:
        """The first ``top`` terms of every group, by value and then by bytes."""
        rows = pa.concat_tables(self.leading).combine_chunks()
        group, value = rows.column("group").to_numpy(), rows.column("value").to_numpy()
        rank = np.zeros(rows.num_rows, np.int64)
        rank[pc.sort_indices(rows.column("term")).to_numpy()] = np.arange(rows.num_rows)
        order = np.lexsort((rank, -value, group))
        first = np.flatnonzero(np.append(True, np.diff(group[order]) != 0)) if len(order) else order
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        return rows.take(pa.array(order[place < self.top]))


#: kind 0: a pair of places (a, b) of ``lang``: high (x), low (y). 1: group a: share x, of y terms. 2: group a: term, value x.
_FOUND = "kind int, lang string, a long, b long, x long, y long, term binary"


def _compared(groups, top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``_FOUND`` of rows lang, term, n, sources, ns; ``groups``: (lang, source) to the group's numbers, by broadcast."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(_FOUND))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, (number, table, of_lang) = _Sums(top), groups.value
        for batch in batches:
            if batch.num_rows:
                take(batch, sums, number, table, of_lang)
        columns = [[] for _ in schema]

        def put(kind: int, **given) -> None:
            rows = max((len(v) for v in given.values() if not isinstance(v, str)), default=0)
            for column, f in zip(columns, schema):
                value = kind if f.name == "kind" else given.get(f.name)
                if value is None or isinstance(value, (int, str)):
                    column.append(pa.repeat(pa.scalar(value, f.type), rows))
                else:
                    column.append(pa.array(value, f.type) if not isinstance(value, pa.Array) else value.cast(f.type))

        for lang, (high, low) in sums.pairs.items():
            a, b = np.nonzero((high != 0) | (low != 0))
            put(0, lang=lang, a=a, b=b, x=high[a, b], y=low[a, b])
        if sums.levels:
            rows = np.concatenate(sums.levels)
            sums.levels = []
            sums.add_levels(rows[:, 0], rows[:, 1], rows[:, 2])
            group, p, n = sums.levels[0].T
            put(1, a=group, x=p, y=n)
        if sums.leading:
            led = sums._led()
            put(2, a=led.column("group").to_numpy(), x=led.column("value").to_numpy(), term=led.column("term").combine_chunks())
        if any(columns):
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], schema=schema)

    def take(batch: pa.RecordBatch, sums: _Sums, number: dict, table: np.ndarray, of_lang: dict) -> None:
        lang, langs = numbered_values(batch.column("lang"))
        lists = batch.column("sources")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        source, sources = numbered_values(lists.flatten())
        n = batch.column("ns").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        pair, which = _numbered(lang[row] * max(1, len(sources)) + source, len(langs) * max(1, len(sources)))
        names, places = langs.to_pylist(), sources.to_pylist()
        group = np.array([number[names[i // len(places)], places[i % len(places)]] for i in pair.tolist()], np.int64)[which]
        place, of, none = table[group].T
        p = shares_of(n, of)
        whole = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
        q = shares_of(whole, np.array([of_lang[x] for x in names], np.int64)[lang])[row]
        sums.add_levels(group, p)
        more = np.flatnonzero(p > q)
        sums.add_leading(group[more], batch.column("term").take(pa.array(row[more])), _squares(p[more], q[more]))
        for i, name in enumerate(names):
            mine, lists_of = lang[row] == i, lang == i
            if mine.any():
                sums.add_pairs(name, place[mine], p[mine], none[mine], sizes[lists_of])

    return run


def _found(terms: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """``_FOUND`` of all terms, where the groups are few enough to be sent to every task."""
    rows = groups.select("lang", "source", "group", "place", F.expr("total + kept").alias("of"), "none").collect()
    number, table, of_lang = {}, np.zeros((len(rows), 3), np.int64), {}
    for r in rows:
        number[r["lang"], r["source"]] = r["group"]
        table[r["group"]] = r["place"], r["of"], r["none"]
    for r in groups.groupBy("lang").agg((F.sum("total") + F.first("kept")).alias("of")).collect():
        of_lang[r["lang"]] = r["of"]
    sent = terms.sparkSession.sparkContext.broadcast((number, table, of_lang))
    bounded_batches(terms.sparkSession)
    return terms.mapInArrow(_compared(sent, top), _FOUND)


def _found_by_joins(terms: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The same where they are too many: shares by joins, pairs of a term's sources by an explosion of its list."""
    each = terms.select("lang", "term", F.col("n").alias("whole"), F.explode(F.arrays_zip("sources", "ns")).alias("e"))
    each = each.select("lang", "term", "whole", F.col("e.sources").alias("source"), F.col("e.ns").alias("n"))
    each = looked_up(each, ["lang", "source"], groups, "terms").withColumn("p", _share(F.col("n"), "total", "kept"))
    of_lang = groups.groupBy("lang").agg(F.sum("total").alias("all"), F.first("kept").alias("v"), F.sum("terms").alias("rows"))
    each = stored(looked_up(each, ["lang"], of_lang, "rows").withColumn("q", _share(F.col("whole"), "all", "v")), "shares")
    blank = {c: F.lit(None).cast("long") for c in ("a", "b", "x", "y")} | {"lang": F.lit(None).cast("string"), "term": F.lit(None).cast("binary")}
    order = [f.split()[0] for f in _FOUND.split(", ")]

    def kind(number: int, rows: DataFrame) -> DataFrame:
        missing = {c: v for c, v in blank.items() if c not in rows.columns}
        return rows.withColumns({"kind": F.lit(number), **missing}).select(*order)

    half = ("place", "p", "none")
    left = each.select("lang", "term", *[F.col(c).alias(f"{c}_a") for c in half])
    right = each.select("lang", "term", *[F.col(c).alias(f"{c}_b") for c in half])
    met = left.join(right, ["lang", "term"]).where("place_a <> place_b")
    more = _apart("p_a", "p_b") - _apart("p_a", "none_b") - _apart("none_a", "p_b") + _apart("none_a", "none_b")
    met = met.select("lang", F.col("place_a").cast("long").alias("a"), F.col("place_b").cast("long").alias("b"), more.alias("m"))
    sums = [F.sum(F.shiftright("m", 32)).alias("x"), F.sum(F.col("m").bitwiseAND(F.lit(0xFFFFFFFF))).alias("y")]
    pairs = met.groupBy("lang", "a", "b").agg(*sums)
    levels = each.groupBy(F.col("group").alias("a"), F.col("p").alias("x")).agg(F.count(F.lit(1)).alias("y"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.col("x").desc(), "term"))
    leading = each.where("p > q").select(F.col("group").alias("a"), _apart("p", "q").alias("x"), "term")
    leading = leading.withColumn("rank", rank).where(F.col("rank") <= top).drop("rank")
    return kind(0, pairs).union(kind(1, levels)).union(kind(2, leading))


def _pairs(found: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value of every two sources of a language.

    A term that only one of two sources has adds an amount that depends on its share alone, so such amounts are made
    per distinct share; for a term both have, the difference was added up per term. The work on a term grows with the
    square of the sources that have it, as the result does.
    """
    exact = "decimal(38,0)"
    levels = found.where("kind = 1").groupBy(F.col("a").alias("group"), F.col("x").alias("p")).agg(F.sum("y").alias("terms"))
    own = groups.select("group", "lang", "place", "none")
    absent = groups.select("lang", F.col("place").alias("other"), F.col("none").alias("q"))
    one = levels.join(own, "group").join(absent, "lang").where("place <> other")
    forth = one.select("lang", F.col("place").alias("a"), F.col("other").alias("b"), (_apart("p", "q").cast(exact) * F.col("terms")).alias("x"))
    back = one.select("lang", F.col("other").alias("a"), F.col("place").alias("b"), (_apart("q", "p").cast(exact) * F.col("terms")).alias("x"))
    met = found.where("kind = 0").select(
        "lang", F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"),
        (F.col("x").cast(exact) * F.lit(1 << 32) + F.col("y").cast(exact)).cast(exact).alias("x"),
    )
    sums = forth.union(back).union(met).groupBy("lang", "a", "b").agg(F.sum(F.col("x").cast(exact)).alias("x"))
    a = groups.select("lang", "source", F.col("place").alias("a"), "kept", F.col("none").alias("p"), F.col("terms").alias("ta"))
    b = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("b"), F.col("none").alias("q"), F.col("terms").alias("tb"))
    every = a.join(b, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
    neither = (F.col("kept") - F.col("ta") - F.col("tb")).cast(exact) * _apart("p", "q").cast(exact)
    value = F.when(F.col("kept") == 0, F.lit(0)).otherwise(F.coalesce("x", F.lit(0).cast(exact)) + neither)
    return every.select("lang", "source", "item", value.cast("long").alias("value"))


def audit(
    documents: DataFrame,
    least: int = 3,
    top: int = 200,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """lang, source, part, item, value, rank: how far every source of a language is from every other one (part
    ``pair``), and which terms it has more of than the language (part ``term``, the first ``top``).

    A language keeps the terms that at least ``least`` of its rows have; every row is a document, also if it repeats.
    The share of a kept term with n occurrences is p = 1 + floor(10^9 (n + 1) / (N + V)); N: occurrences of all kept
    terms, V: their number. A value is floor((p - q)^2 / q), summed over the kept terms for a pair. All arithmetic is in
    whole numbers. Ranks go by value, larger first, then by the item's UTF-8 bytes.

    Null texts, languages and sources are empty strings; a source without terms takes part in pairs; without kept terms
    values are 0; an empty table gives an empty one; texts and terms of any length are taken whole; extra columns are
    ignored. A source with a third of all rows is counted in batches before any shuffle.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = documents.select(empty(lang).alias("lang"), empty(source).alias("source"), empty(text).alias("content"))
    kept = stored(frequent_terms(docs.select("lang", "content"), least), "kept")
    terms = stored(term_counts(docs, kept), "terms")
    each = terms.select("lang", F.explode(F.arrays_zip("sources", "ns")).alias("e"))
    words = each.groupBy("lang", F.col("e.sources").alias("source")).agg(
        F.sum("e.ns").alias("total"), F.count(F.lit(1)).alias("terms")
    )
    groups = docs.select("lang", "source").distinct().join(words, ["lang", "source"], "left")
    groups = groups.join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept")), "lang", "left").fillna(0)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.withColumn("place", place)
    # Numbers over all languages: a language's groups follow those of the languages before it.
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("lang").rowsBetween(Window.unboundedPreceding, -1)
    starts = langs.select("lang", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    groups = groups.join(starts, "lang").withColumn("group", F.col("start") + F.col("place"))
    none = F.when(F.col("kept") > 0, _share(F.lit(0), "total", "kept")).otherwise(1)
    groups = stored(groups.withColumn("none", none).drop("start"), "groups")
    by = _found if groups.count() <= GROUPS else _found_by_joins
    found = stored(by(terms, groups, top), "found")
    names = groups.select(F.col("group").alias("a"), "lang", "source")
    leading = found.where("kind = 2").select("a", F.col("term").cast("string").alias("item"), F.col("x").alias("value"))
    leading = leading.join(names, "a").select("lang", "source", "item", "value")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(_pairs(found, groups), "pair").union(ranked(leading, "term").where(F.col("rank") <= top))
