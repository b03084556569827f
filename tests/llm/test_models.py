"""Language model, toxicity, mixing and pages: exact counts, round numbers, held-out quality."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.helpers import documents, prose, texts
from tidemark.llm import lm, mixing, template, toxicity
from tidemark.llm.queries import QUERIES


def held(i, folds, rest):
    return zlib.crc32(str(i).encode()) % folds == rest if i is not None else 0 == rest


def chains(n, seed=1):
    """Texts in two invented languages: what follows a word depends on it."""
    rng = random.Random(seed)
    kinds = [[f"{k}{a}{b}" for a in "abcdef" for b in "xyz"] for k in "mn"]
    out = []
    for i in range(n):
        words, line, at = kinds[i % 2], [], rng.randrange(18)
        for _ in range(60):
            line.append(words[at])
            at = (at * 5 + rng.choice([1, 1, 1, 2])) % 18
        out.append((i, " ".join(line)))
    return out


def test_scores(spark):
    rows = chains(400) + [(1000 + (i or 0), t) for i, t in texts() if i != 10] + [(None, "max may")]
    made = lm.score(documents(spark, rows)).collect()
    assert len(made) == len(rows)
    counts, ends = Counter(), 0
    for i, t in rows:
        if not held(i, 7, 2):
            counts.update((t or "").encode().lower().split())
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    want = Counter()
    for i, t in rows:
        words = (t or "").encode().lower().split()
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((ends + 1) / (n + v + 1))
        want[i, held(i, 7, 2), len(words) + 1, sum(w in counts for w in words) + 1, n, round(base, 6)] += 1
    found = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in made)
    assert found == want
    own = [r for r in made if r.held_out and r.doc_id is not None and r.doc_id < 400]
    gain = sum(r.score - r.base_score for r in own) / sum(r.n_tokens for r in own)
    assert gain > 0.02 and all(math.isfinite(r.score) and r.score < 0 for r in made)
    assert lm.score(documents(spark, [])).collect() == []


def test_probabilities_sum_to_one():
    frequencies = np.full(lm.UNITS, 1 / lm.UNITS)
    p = lm.start(frequencies)
    a1, a2, log_z = lm.log_probabilities(p)
    for u, v in ((0, 0), (5, 900), (1023, 1)):
        assert abs(np.exp(a1[u] + a2[v] - log_z[u, v]).sum() - 1) < 1e-4


def toxic_texts(n=600):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        words = prose(i, 40).split()
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), "grubnik" + rng.choice(["", "s", "en", "ly"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_texts(spark):
    rows, labels = toxic_texts()
    extra = [(2000 + (i or 0), t) for i, t in texts()]
    frame = spark.createDataFrame([*labels, (5000, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    made = toxicity.score(documents(spark, rows + extra), frame).collect()
    assert len(made) == len(rows + extra)
    truth = {i: y for i, _, y in labels}
    tested = [r for r in made if r.held_out and r.doc_id in truth]
    assert len(tested) > 80 and sum(r.predicted == truth[r.doc_id] for r in tested) >= 0.95 * len(tested)
    for r in made:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == held(r.doc_id, 5, 0)
    scores = {r.doc_id: r.score for r in made}
    assert scores[2006] == scores[2007] and scores[2001] == scores[2002]


def test_labels_of_the_held_out_fold_change_nothing(spark):
    rows, labels = toxic_texts(150)
    turned = [(i, q, 1 - y if held(i, 5, 0) else y) for i, q, y in labels]
    schema = "doc_id long, quality int, toxic int"
    runs = [
        sorted(map(tuple, toxicity.score(documents(spark, rows), spark.createDataFrame(x, schema)).collect()))
        for x in (labels, turned)
    ]
    assert runs[0] == runs[1]


def test_lists_are_mined_from_all_labelled_rows(spark, monkeypatch):
    rows, labels = toxic_texts()
    mined, mine = [], toxicity.mine
    monkeypatch.setattr(toxicity, "SAMPLE", 30)
    monkeypatch.setattr(toxicity, "mine", lambda training: mined.extend(mine(training)) or mined)
    toxicity.score(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    truth = {i: y for i, _, y in labels if not held(i, 5, 0)}
    counts, totals = [Counter(), Counter()], Counter(truth.values())
    for i, text in rows:
        if i in truth:
            words = set(text.split())
            counts[truth[i]].update(words | {w[:n] + "*" for w in words for n in (4, 5, 6) if len(w) > n})
    ratio = (totals[0] + 1) / (totals[1] + 1)
    want = {f for f, n in counts[1].items() if n >= 5 and n / (counts[0][f] + 0.5) * ratio >= 4}
    assert set(mined) == want and len(mined) == len(want) and {"grubnik", "grubnikly", "grub*"} <= want


def test_telling_words_are_not_crowded_out_by_common_ones(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FEATURES", 1)
    common = " ".join(f"{a}{b}" for a in "abcdef" for b in "xyzuv")
    rows = [(f"{common} grub" if k < 5 else common, int(k < 40)) for k in range(100)]
    training = spark.createDataFrame(rows, "words string, toxic int")
    assert toxicity.mine(training) == ["grub"]


def test_toxicity_without_labels(spark):
    rows = [(1, "you are an idiot and a loser"), (2, "a calm line of plain words"), (3, None)]
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    made = {r.doc_id: r.score for r in toxicity.score(documents(spark, rows), empty).collect()}
    assert made[1] > made[2] and made.keys() == {1, 2, 3}
    assert toxicity.score(documents(spark, []), empty).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_flight_keeps_totals(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 300)
    sizes = [float(rng.choice([1, 5, 5, 700, rng.randint(1, 10_000)])) for _ in range(n)]
    p = [rng.random() for _ in range(n)]
    q = mixing.flight(p, sizes, rng)
    assert sum(0 < x < 1 for x in q) <= 2 and all(0 <= x <= 1 for x in q)
    assert abs(sum(p) - sum(q)) < 1e-5
    assert abs(sum(a * s for a, s in zip(p, sizes)) - sum(a * s for a, s in zip(q, sizes))) < 1e-2


def test_flight_keeps_probabilities_on_average():
    sizes, p = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0], [0.2, 0.7, 0.5, 0.5, 0.9, 0.4]
    draws = [mixing.flight(p, sizes, random.Random(k)) for k in range(4000)]
    assert np.abs(np.mean(draws, axis=0) - p).max() < 0.03


def test_shares():
    assert mixing.shares([100, 100, 100], [5, 2, 1], 450) == pytest.approx([200, 500 / 3, 250 / 3])
    assert mixing.shares([10, 0, 10], [5, 2, 1], 30) == pytest.approx([20, 0, 10])
    assert mixing.shares([], [], 0) == [] and mixing.shares([0], [5], 0) == [0]


@pytest.mark.parametrize("chunk", [2000, 20])
def test_mix(spark, chunk):
    rows = [r for r in texts() if r[0] != 10] + [(100 + k, prose(k, k % 37)) for k in range(300)]
    docs = documents(spark, rows)
    made = mixing.mix(docs, chunk=chunk).collect()
    assert len(made) == len(rows)
    sources = {}
    for (i, t), source in zip(rows, itertools.cycle(["a", "b", None])):
        sources.setdefault(source, []).append(len((t or "").split()))
    total = {s: sum(x) for s, x in sources.items()}
    order = ["a", "b", None]
    goal = dict(zip(order, mixing.shares([total[s] for s in order], [5, 2, 1], 1.5 * sum(total.values()))))
    for s in order:
        own = [r for r in made if r.source_size == total[s]]
        assert len(own) == len(sources[s]) and {r.target for r in own} == {goal[s]}
        assert abs(sum(r.taken for r in own) - goal[s]) <= (40 if chunk == 2000 else 200)
    assert all(r.taken <= 2 * r.size and r.taken % max(1, r.size) == 0 for r in made)
    again = mixing.mix(docs.repartition(5), chunk=chunk)
    assert sorted(map(repr, made)) == sorted(map(repr, again.collect()))
    mixed = mixing.mixed_documents(docs, chunk=chunk)
    assert mixed.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in made)


def test_repeated_rows_are_dealt_to_many_chunks(spark, monkeypatch):
    rows = [(None, "one two three")] * 900 + [(None, f"{k} b c") for k in range(300)]
    docs = documents(spark, rows).drop("source").selectExpr("*", "'a' as source")
    largest, fly = [], mixing._fly
    size = "max(size(units))"
    monkeypatch.setattr(mixing, "_fly", lambda g, last: largest.append(g.selectExpr(size).first()[0]) or fly(g, last))
    made = mixing.mix(docs, chunk=20).collect()
    assert len(made) == len(rows) and largest[0] <= 60
    assert abs(sum(r.taken for r in made) - made[0].target) <= 6
    again = mixing.mix(docs.repartition(5), chunk=20).collect()
    assert sorted(map(repr, made)) == sorted(map(repr, again))


def test_mix_of_no_rows(spark):
    assert mixing.mix(documents(spark, [])).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style><script>var x = "</p><p>no";</script></head>
<body><header class=site><h2>Site name</h2></header><nav><ul><li><a href=/{n}>Menu {n}</a></ul></nav>
<div class="cookie-notice">We use cookies {n}</div>{main}
<aside><p>Side {n}</p></aside><div id="comments"><p>Comment {n}</p></div>
<form><label>Mail</label><input value=x></form><footer>&copy; {n}</footer></body></html>"""


def pages():
    rng = random.Random(8)
    rows, want = [], []
    for n in range(12):
        first, second = prose(rng.random(), 30), prose(rng.random(), 20)
        main = f"<article><h1>Title&nbsp;{n} &amp; more</h1><p>{first}\n <b>bold<br>next</b><p>{second}<!-- x --></article>"
        rows.append((n, f"http://one.example/{n}", PAGE.format(n=n, main=main)))
        want.append(f"Title {n} & more\n\n{first} bold next\n\n{second}")
    for n in range(12, 20):  # no article, only containers
        first, second = prose(rng.random(), 30), prose(rng.random(), 25)
        main = f'<div class="wrap"><div class="body c{n}"><p>{first}</p><p>{second}</p><p>Read on here</p></div></div>'
        rows.append((n, f"https://two.example:80/{n}", PAGE.format(n=n, main=main)))
        want.append(f"{first}\n\n{second}")
    same = PAGE.format(n=7, main="<article><p>" + prose(1, 40) + "</p></article>")
    for n in range(20, 26):  # copies of one page on one host
        rows.append((n, "http://three.example/x", same))
        want.append(prose(1, 40))
    alone = "<p>Only &lt;one&gt; page</p><div hidden>gone</div><textarea>gone</textarea>"
    for n, (url, html, text) in enumerate(
        [
            ("http://four.example", alone, "Only <one> page"),
            (None, None, ""),
            ("not a url", "", ""),
            ("http://four.example", "<nav>menu</nav>", ""),
            (None, "<article>" + "w " * 50_000 + "</article>", " ".join(["w"] * 50_000)),
            ("http://five.example", "plain text, no markup", "plain text, no markup"),
        ]
    ):
        rows.append((30 + n, url, html))
        want.append(text)
    rows.append(rows[0])
    want.append(want[0])
    return rows, want


def test_pages(spark):
    rows, want = pages()
    frame = spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, html string, host string, path string")
    made = template.extract(frame).collect()
    found = Counter((r.page_id, r.url, r.text, r.n_chars) for r in made)
    assert found == Counter((i, u, t, len(t)) for (i, u, _), t in zip(rows, want))
    schema = "page_id long, url string, html string"
    assert template.extract(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize(
    "inside, text",
    [
        ("<section id='related-work'><p>Old work</p></section>", "Start\n\nOld work\n\nEnd"),
        ("<h2 id='search-and-replace'>Search and replace</h2>", "Start\n\nSearch and replace\n\nEnd"),
        ("<div class='print'>A print</div><figure class='share-price'>Ten</figure>", "Start\n\nA print\n\nTen\n\nEnd"),
        ("<div class='related'><a href=1>One more</a> <a href=2>Two more</a></div>", "Start\n\nEnd"),
        ("<p>If <math><mi>x</mi></math> <object>fallback</object></p>", "Start\n\nIf x fallback\n\nEnd"),
        ("<select><option>gone</option></select><svg><text>gone</text></svg>", "Start\n\nEnd"),
        ("<p><svg><math><object>", "Start\n\nEnd"),
    ],
)
def test_names_and_odd_elements_keep_the_article(inside, text):
    made = template.main_text(f"<article><p>Start</p>{inside}<p>End</p></article>", frozenset(), None)
    assert made == text


def test_template_decides_without_names(spark):
    """Menus, adverts and notices in plain divs go by the template alone, also where they are longer than the text."""
    menu = "<div><span>Home</span><div>World news of the day and the week</div><div>Sport and weather for you</div></div>"
    notice = "<div>All rights are kept by the house and whoever else may hold some of them</div>"
    rows = []
    for n in range(10):
        wrap = ("<article>{}</article>", "<div><div>{}</div></div>")[n % 2]
        rows.append((n, f"http://h{n % 2}.example/{n}", wrap.format(f"{menu}<p>{prose(n, 6)}</p><p>{prose(100 + n, 6)}</p>{notice}")))
    rows += [(20 + n, "http://h0.example/copy", rows[0][2]) for n in range(30)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    made = {r.page_id: r.text for r in template.extract(frame).collect()}
    for n in range(10):
        assert made[n] == f"{prose(n, 6)}\n\n{prose(100 + n, 6)}"
    assert all(made[20 + n] == made[0] for n in range(30))


def extracted(spark, htmls):
    frame = spark.createDataFrame([(n, f"http://h.example/{n}", h) for n, h in enumerate(htmls)], "page_id long, url string, html string")
    return [r.text for r in template.extract(frame).orderBy("page_id").collect()]


def test_what_articles_share_is_kept(spark):
    """Headings, recipe lines and near copies stand between texts that vary."""
    papers = [f"<article><h1>{prose(n, 4)}</h1><h2>Abstract</h2><p>{prose(n, 30)}</p><h2>References</h2><p>{prose(50 + n, 20)}</p></article>" for n in range(6)]
    for n, text in enumerate(extracted(spark, papers)):
        assert text.split("\n\n") == [prose(n, 4), "Abstract", prose(n, 30), "References", prose(50 + n, 20)]
    recipes = [f"<article><p>Preheat the oven to 200 degrees.</p><p>{prose(n, 20)}</p><p>Serve warm.</p></article>" for n in range(4)]
    for n, text in enumerate(extracted(spark, recipes)):
        assert text == f"Preheat the oven to 200 degrees.\n\n{prose(n, 20)}\n\nServe warm."
    near = [f"<article><h1>Same story</h1><p>{prose(9, 60)}</p><p>Updated {n}</p></article>" for n in range(4)]
    for n, text in enumerate(extracted(spark, near)):
        assert text == f"Same story\n\n{prose(9, 60)}\n\nUpdated {n}"


@pytest.mark.parametrize("top", ["main", "article"])
@pytest.mark.parametrize(
    "inside",
    [
        "<section id='comments'><h3>3 replies</h3><p>Nice post, thanks!</p></section>",
        "<div class='comments'><article><p>I disagree.</p></article></div>",
        "<ol class='comment-list wide'><li>First!</li></ol>",
        "<div class='advert'>Buy now, it is cheap.</div>", "<div class='newsletter'><p>Read us each week.</p></div>",
        "<div class='Sidebar'>Other things</div>", "<div class='cookie-notice'>We use cookies.</div>", "<div id='disqus_thread'>x</div>",
    ],
)
def test_furniture_inside_the_article_goes(top, inside):
    text = "<p>Start here.</p>" + ("" if top == "article" else "<h2>More</h2>") + "<p>The end.</p>"
    made = template.main_text(f"<body><{top}>{text}{inside}</{top}></body>", frozenset(), None)
    assert made == ("Start here.\n\nThe end." if top == "article" else "Start here.\n\nMore\n\nThe end.")


def test_main_is_only_a_container():
    made = template.main_text("<main><p>Share this page</p><article><p>Text.</p></article><p>Next page</p></main>", frozenset(), None)
    assert made == "Text."


def test_deep_nesting_needs_memory_by_size_only():
    import tracemalloc

    html = "<article>" + "<div>" * 30_000 + "<p>deep</p>"
    tracemalloc.start()
    assert template.main_text(html, frozenset(), None) == "deep"
    assert tracemalloc.get_traced_memory()[1] < 50e6
    tracemalloc.stop()


def test_classes_equal_brute_force(spark):
    """Vectors written out as dictionaries of pages: the same classes as by hashes, at the bounds of support too."""
    htmls = [
        "<div><p>all</p></div><ul><li>all too</li></ul>" + ("<div class=h><p>half</p><p>half again</p></div>" if n % 2 else "")
        + ("<h3>less</h3><h3>less again</h3>" if n < 4 else "") + f"<p>{prose(n, 5)}</p>"
        for n in range(10)
    ]
    for pages_of_host in (10, 4, 2):
        vectors = {}
        for n, html in enumerate(htmls[:pages_of_host]):
            paths, found = template.blocks(html)
            counts = Counter({(p, None): c for p, c in paths.items()})
            counts.update((b[0], template._key(b[0], b[1])) for b in found)
            for token, times in counts.items():
                vectors.setdefault(token, {})[n] = times
        enough = {t: v for t, v in vectors.items() if len(v) >= 0.5 * pages_of_host and (len(v) >= 3 or t[1] is None)}
        classes = {}
        for token, v in enough.items():
            classes.setdefault(tuple(sorted(v.items())), set()).add(token)
        want = {t for c in classes.values() if len(c) >= 2 for t in c if t[1] is not None}
        frame = spark.createDataFrame([(n, "http://x.example", h) for n, h in enumerate(htmls[:pages_of_host])], "page_id long, url string, html string")
        made = template.templates(template.tokens(frame)).first()
        nested = {""}
        for path in sorted((t[0] for c in classes.values() if len(c) >= 2 for t in c if t[1] is None), key=lambda p: (p.count(">"), p)):
            if path.rpartition(">")[0] in nested:
                nested.add(path)
        assert set(made.element_keys) == {template._key(p) for p in nested}
        assert set(made.text_keys) == {k for p, k in want if p.rpartition(">")[0] in nested}


def test_template_is_one_class_of_the_host(spark):
    rows = [r for r in pages()[0] if 12 <= r[0] < 20]
    counted = template.tokens(spark.createDataFrame(rows, "page_id long, url string, html string"))
    made = template.templates(counted).collect()
    assert [r.host for r in made] == ["two.example"]
    assert template._key(">html>body>div.wrap>div.body.c#>p", "Read on here") in made[0].text_keys


def test_pipeline(spark):
    from pathlib import Path

    sf_dir = "/root/testdata/sf0.001"
    if not Path(sf_dir).exists():
        pytest.skip("no shared tables here")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, previous = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, previous, sf_dir)
        assert out.columns == names, name
        previous = spark.createDataFrame(out.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, previous, sf_dir)
    rows = sorted(map(tuple, last.drop("ids").collect()))
    assert rows == sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).drop("ids").collect())) and rows


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
