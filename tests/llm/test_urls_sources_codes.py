"""The url filter, the audit of sources and the vector codes against plain Python versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.llm.helpers import documents, prose
from tidemark.llm import codes, divergence, hosts
from tidemark.llm.queries import URL_RULES

# --- urls

PAGES = T.StructType(
    [T.StructField(n, k) for n, k in (
        ("page_id", T.LongType()), ("url", T.StringType()), ("html", T.StringType()),
        # Names the operator uses inside.
        ("host", T.StringType()), ("n_pages", T.LongType()), ("_hot", T.StringType()), ("good", T.BooleanType()),
    )]
)


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def domain_and_suffix(host):
    bare = re.sub(r"[.]+$", "", re.sub(r":[0-9]*$", "", re.sub(r"^.*@", "", host)))
    names = bare.split(".")
    taken = 2 if len(names) > 1 and len(names[-1]) == 2 and names[-2] in hosts.SECOND_LEVEL else 1
    if re.fullmatch(r"[0-9.]+", bare) or bare.startswith("[") or len(names) <= taken:
        return bare, bare
    return ".".join(names[-taken - 1:]), ".".join(names[-taken:])


def rho(members):
    """members: (parent, n, k); the estimate written out member by member."""
    of = defaultdict(list)
    for parent, n, k in members:
        if n:
            of[parent].append((n, k))
    more = full = 0.0
    for rows in of.values():
        N, K = sum(n for n, _ in rows), sum(k for _, k in rows)
        p, pq, W = K / N, K * (N - K) / N**2, sum((n / N) ** 2 for n, _ in rows)
        for n, k in rows:
            c = 1 - 2 * n / N + W
            more += (k - n * p) ** 2 - n * pq * c
            full += n * (n - 1) * pq * c
    return 0.5 if full < 1e-9 else round(min(max(more / full, 1e-6), 0.999), 9)


def brute_verdicts(urls, rules, least=0.5, z=1.645):
    rows = []
    for url in urls:
        host, path = split_url(url)
        fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
        rows.append((host, path, best[1] + best[2] if best else None, best[0] if best else None))
    n, k = Counter(), Counter()
    for host, _, _, verdict in rows:
        n[host] += verdict is not None
        k[host] += verdict == "allow"
    where = {h: domain_and_suffix(h) for h in n}
    dn, dk, sn, sk = Counter(), Counter(), Counter(), Counter()
    for h, (d, s) in where.items():
        dn[d] += n[h]; dk[d] += k[h]; sn[s] += n[h]; sk[s] += k[h]  # noqa: E702
    suffix_of = {d: s for d, s in where.values()}
    weigh = lambda r: 1 / r - 1
    a = weigh(rho([(0, sn[s], sk[s]) for s in sn]))
    b = weigh(rho([(suffix_of[d], dn[d], dk[d]) for d in dn]))
    c = weigh(rho([(where[h][0], n[h], k[h]) for h in n]))
    total = sum(n.values())
    root = (sum(k.values()) + 0.5) / (total + 1)

    def shrink(weight, n, k, mean, var):
        m = (weight * mean + k) / (weight + n)
        return m, m * (1 - m) / (weight + n + 1) + (weight / (weight + n)) ** 2 * var

    out = []
    for host, path, rule, verdict in rows:
        if verdict is None:
            d, s = where[host]
            of_suffix = shrink(a, sn[s], sk[s], root, root * (1 - root) / (total + 2))
            of_domain = shrink(b, dn[d], dk[d], *of_suffix)
            mean, var = shrink(c, n[host], k[host], *of_domain)
            verdict = "block" if min(1.0, mean + z * math.sqrt(var)) < least else "allow"
        out.append((host, path, rule, verdict))
    return out


def urls():
    rng = random.Random(5)
    out = [None, "", "no scheme", "x://", "http://?q", "ftp://[::1]:80/de/1", "http://10.0.0.1/de/", "HTTP://A.Example.ORG/es/x",
           "http://example.org/es/", "http://example.org/en/15", "http://notexample.org/es/", "http://user:p@www.b.co.uk:8080/de/2",
           "http://com/de/", "http://a.com/DE/", "http://a.com#x", "http://a.com?/de/", "http://É.com/fr/é", "a://b://c.com/de/", "http://x.com./de/",
           "http://long.com/" + "y" * 50_000]
    for i in range(400):
        site = rng.choice(["bad.com", "good.com", "mixed.com", "news.net", "a.b.org", "shop.co.uk"])
        lang = "de" if site == "bad.com" and rng.random() < 0.9 else rng.choice(["fr", "en", "en", "de" if site == "mixed.com" else "it"])
        out.append(f"https://{rng.choice(['www', 'm', 'blog'])}.{site}/{lang}/{rng.randint(1, 30)}")
    return out + ["https://www.bad.com/de/1"] * 300  # one host, and one row, far more often than others


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, "<p>", "h", 1, "x", None) for i, u in rows], PAGES)


def test_hosts_equal_brute_force(spark):
    given = urls()
    rows = list(enumerate(given)) + [(None, "https://www.bad.com/en/7")] * 2
    got = hosts.judged(pages_of(spark, rows).repartition(3), URL_RULES).collect()
    want = brute_verdicts([u for _, u in rows], URL_RULES)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got], key=key) == sorted(
        [(i, *w) for (i, _), w in zip(rows, want)], key=key
    )
    verdicts = {r.host: r.verdict for r in got if r.rule is None}
    assert verdicts["www.bad.com"] == "block" and verdicts["www.good.com"] == "allow" and verdicts["www.news.net"] == "allow"


def test_hosts_little_evidence_is_shrunk_and_own_outcomes_may_be_given(spark):
    rows = [(i, f"http://h{i % 10}.old.com/") for i in range(200)] + [(900, "http://new.old.com/"), (901, "http://one.fine.net/"), (902, "http://one.fine.net/")]
    pages = pages_of(spark, rows).withColumn("seen", F.when(F.col("page_id") < 190, False).when(F.col("page_id") == 901, True))
    out = {r.page_id: r for r in hosts.judged(pages, [], F.col("seen")).collect()}
    # A host without outcomes inherits its domain's; one good page does not make a share of 1.
    assert out[900].verdict == "block" and out[900].share < 0.1 and out[902].verdict == "allow" and out[902].share < 1
    none = hosts.judged(pages_of(spark, rows[:4]), []).collect()
    assert {r.verdict for r in none} == {"allow"} and {r.share for r in none} == {0.5}
    assert hosts.judged(pages_of(spark, []), URL_RULES).count() == 0


def test_hosts_plan_has_no_python(spark):
    plan = hosts.judged(pages_of(spark, list(enumerate(urls()[:30]))), URL_RULES)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- sources


def brute_audit(rows, least=3, top=200):
    lower = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    docs = [(la or "", so or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(lower))) for t, la, so in rows]
    df, n = Counter(), Counter()
    for la, so, words in docs:
        df.update((la, w) for w in set(words))
        n.update((la, so, w) for w in words)
    groups = sorted({(la, so) for la, so, _ in docs})
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(w for (la, w), d in df.items() if la == lang and d >= least)
        of = [so for la, so in groups if la == lang]
        total = {so: sum(n[lang, so, w] for w in kept) for so in of}
        share = lambda c, N: 1 + 10**9 * (c + 1) // (N + len(kept))
        p = {so: {w: share(n[lang, so, w], total[so]) for w in kept} for so in of}
        q = {w: share(sum(n[lang, so, w] for so in of), sum(total.values())) for w in kept}
        apart = lambda a, b: (a - b) ** 2 // b
        for so in of:
            pairs = [(o, sum(apart(p[so][w], p[o][w]) for w in kept)) for o in of if o != so]
            terms = [(w, apart(p[so][w], q[w])) for w in kept if n[lang, so, w] and p[so][w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, so, part, item, value, i) for i, (item, value) in enumerate(ranked, 1)}
    return out


def source_rows():
    rng = random.Random(3)
    long_word = "é" * 300
    rows = [(None, None, None), ("", "en", "a"), ("one two", None, "a"), ("...", "xx", None), ("zz", "xx", "b"),
            ("Same Row ÀÉ straße", "en", "a"), ("Same Row ÀÉ straße", "en", "a"), ("same row àé STRASSE", "en", None)]
    words = [prose(i, 1) for i in range(60)] + ["abcdef", "abcdefg", "abcdefgh", "abcdefghijklm", "abcdefghijkln", long_word, long_word + "x", "x" * 5000]
    for i in range(120):
        source = "hot" if i % 3 == 0 else f"s{i % 5}"
        rows.append((" ".join(rng.choices(words, k=rng.randint(1, 60))), rng.choice(["en", "de"]), source))
    rows.append((prose(77, 20_000), "en", "long"))
    return rows


@pytest.mark.parametrize("top, few", [(200, True), (3, True), (200, False), (3, False)])
def test_audit_equals_brute_force(spark, monkeypatch, top, few):
    if not few:
        monkeypatch.setattr(divergence, "GROUPS", 0)
        monkeypatch.setattr(divergence, "PAIRS", 7)
    rows = source_rows()
    schema = "text string, lang string, source string, prefix string, n long, place int"
    df = spark.createDataFrame([(*r, "p", 1, 2) for r in rows], schema).repartition(5)
    got = [tuple(r) for r in divergence.audit(df, top=top).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_audit(rows, top=top)


def test_audit_of_no_rows_and_of_no_terms(spark):
    schema = "text string, lang string, source string"
    assert divergence.audit(spark.createDataFrame([], schema)).count() == 0
    got = {tuple(r) for r in divergence.audit(spark.createDataFrame([("a", "en", "x"), ("b", "en", None)], schema)).collect()}
    assert got == {("en", "", "pair", "x", 0, 1), ("en", "x", "pair", "", 0, 1)}


def test_shares_are_exact():
    rng = random.Random(4)
    for of in (1, 7, 10**6 + 3, 2**52 + 1):
        n = [0, of - 1, *(rng.randrange(of) for _ in range(50))]
        got = divergence.shares_of(np.array(n), np.full(len(n), of))
        assert got.tolist() == [1 + 10**9 * (x + 1) // of for x in n]


@pytest.mark.parametrize("first", [1, 2, 6])
def test_refinement_keeps_exactly_the_frequent_terms(spark, monkeypatch, first):
    monkeypatch.setattr(divergence, "FIRST_PREFIX", first)
    rows = [(la, t) for t, la, _ in source_rows() if la and t]
    df = spark.createDataFrame([(la, t) for la, t in rows], "lang string, content string")
    got = {(r.lang, bytes(r.term)): r.docs for r in divergence.frequent_terms(df, 3).collect()}
    want = Counter()
    for la, t in rows:
        words = re.findall(rb"[A-Za-z\x80-\xff]+", t.encode())
        want.update((la, w) for w in {w.lower() for w in words})
    assert got == {k: v for k, v in want.items() if v >= 3}


# --- codes


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """rows: (key, label, vector); whole numbers of any size, one vector at a time."""
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    sound = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    sound = sorted(sound, key=order)
    sound = [r for r in sound if len(r[2]) == len(sound[0][2])]
    points = []
    for _, _, v in sound:
        whole = [math.floor(Fraction(x) * scale) for x in v]
        whole += [0] * (-len(whole) % parts)
        w = len(whole) // parts
        points.append([whole[i * w : (i + 1) * w] for i in range(parts)])
    books = [[p[i] for p in points[:entries]] for i in range(parts)]

    def near(part, i):
        d = [sum((x - y) ** 2 for x, y in zip(part, e)) for e in books[i]]
        return min(range(len(d)), key=lambda j: (d[j], j)), min(d)

    for _ in range(rounds):
        found = [[near(p[i], i)[0] for p in points] for i in range(parts)]
        for i in range(parts):
            for j in range(len(books[i])):
                mine = [p[i] for p, f in zip(points, found[i]) if f == j]
                if mine:
                    books[i][j] = [sum(c) // len(mine) for c in zip(*mine)]
    digest = hashlib.sha256(",".join(str(y) for b in books for e in b for y in e).encode()).hexdigest()
    coded = [[near(p[i], i) for i in range(parts)] for p in points]
    errors = [sum(d for _, d in c) for c in coded]
    per_label = Counter()
    for r, e in zip(sound, errors):
        per_label[r[1]] += e
    return [(r[0], r[1], "".join(f"{j:02x}" for j, _ in c), e, per_label[r[1]], digest) for r, c, e in zip(sound, coded, errors)]


VECTORS = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
     T.StructField("code", T.StringType()), T.StructField("members", T.LongType())]
)


def check_codes(spark, rows, **options):
    df = spark.createDataFrame([(k, v, la, "c", 1) for k, la, v in rows], VECTORS).repartition(3)
    got = [tuple(r) for r in codes.compressed(df, **options).collect()]
    as_floats = [(k, la, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for k, la, v in rows]
    want = brute_codes(as_floats, **options) if got else []
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return got


def vectors(n, width, seed=1, scale=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, scale) for _ in range(width)] for _ in range(5)]
    return [[x + rng.gauss(0, scale / 10) for x in rng.choice(centres)] for _ in range(n)]


@pytest.mark.parametrize("width", [8, 24, 20])
def test_codes_equal_brute_force(spark, width):
    rows = [(i, i % 3 if i % 4 else None, v) for i, v in enumerate(vectors(90, width))]
    rows += [(500, 1, rows[0][2])] * 40  # ties and repeated rows
    rows += [(None, 1, rows[3][2]), (3, None, None), (-1, 1, [float("nan")] * width), (-2, 1, [None] * width), (-3, 2, [float("inf")] * width)]
    rows += [(600, 2, [0.0] * width), (601, 2, [1.0] * (width + 8)), (602, 2, [])]
    assert len(check_codes(spark, rows)) == 90 + 40 + 2


def test_codes_of_few_none_and_empty_vectors(spark):
    assert check_codes(spark, []) == [] and check_codes(spark, [(1, 1, None)]) == []
    assert len(check_codes(spark, [(i, 0, v) for i, v in enumerate(vectors(5, 16))])) == 5
    empty = codes.compressed(spark.createDataFrame([(1, [], 3, "c", 1), (2, [], None, "c", 1)], VECTORS)).collect()
    assert [(r.code, r.error, r.label_error) for r in empty] == [("00" * 8, 0, 0)] * 2


def test_codes_of_large_components_take_two_limbs(spark):
    rows = [(i, 0, v) for i, v in enumerate(vectors(60, 16, scale=9000.0))]
    check_codes(spark, rows, entries=4, rounds=3)
    with pytest.raises(Exception, match="would not fit 64 bits"):
        codes.compressed(spark.createDataFrame([(1, [1e30] * 8, 0, "c", 1)], VECTORS)).collect()


def test_limbs_and_products_are_exact():
    rng = np.random.default_rng(2)
    for bits, width in ((10, 5), (24, 96), (28, 33)):
        a = rng.integers(-(1 << bits), 1 << bits, (40, width))
        b = rng.integers(-(1 << bits), 1 << bits, (7, width))
        assert (codes.exact_products(a, b) == (a.astype(object) @ b.T.astype(object))).all()
        parts = codes.limbs(a, 11)
        assert (sum(p.astype(np.int64) << (11 * i) for i, p in enumerate(parts)) == a).all()
        assert all(np.abs(p).max() <= 1 << 11 for p in parts)


def test_new_operators_take_any_documents(spark):
    rows = documents(spark)
    assert {r.part for r in divergence.audit(rows).collect()} <= {"pair", "term"}
