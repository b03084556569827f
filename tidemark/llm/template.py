"""Main text of web pages by template deduction.

Pages of one host are cut into tokens: element paths and the texts of blocks at their paths. Tokens with equal occurrence
vectors over the host's pages form an equivalence class; the vectors are never gathered, a token's is known by its number of
pages, its occurrences and a hash folded over (page, count). Classes that stand on enough of the pages and hold more than one
token are valid and are nested into the host's template, outermost paths first, each below a path that is in it. What is
not template fills slots. Slots inside menus, headers, footers, sidebars, notices, adverts, forms and comments, known by
their elements and attributes, are dropped. Some names say so anywhere, whole class names and ids such as ``comments`` or
``sidebar``; parts of names say so outside of articles only, or of a text that is mostly links. Of the other slots
the article's are the main text, or, where the page marks none, those of ``main``, or else those of the template's element that
holds most slot text on the host. A text of the template is dropped, but
inside an article only if its element holds nothing but template on the host and is no heading or paragraph between
slots: headings and lines that articles share are kept. Pages of a host whose
whole texts are equal are copies and count once, so pages that copy one another keep their text.

Template means on half of the host's different pages and on three at least (SUPPORT, LEAST_PAGES); equal vectors are told by
hashes of 63 bits. Html of any length is read whole; elements nested deeper than DEPTH share the path of the one at that depth,
so a page's paths grow with its size.

Tokens are counted per batch before the shuffle, so a host with a third of all pages is no hot group; pages move once, to find copies; a template holds only
tokens that stand on half of the host's pages, so its size follows the size of a page. Null or empty html, and pages
without main text, give the empty string. Null or broken urls share the host "". Repeated rows are copies and are extracted row
by row; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_batch, stored

#: A valid class stands on this share of a host's pages, on so many pages, and has so many tokens.
SUPPORT, LEAST_PAGES, LEAST_TOKENS = 0.5, 3, 2
#: Steps of a path at most.
DEPTH = 100
#: Templates up to this size are sent to every executor; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20

#: Elements of the markup language by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg select".split())
#: Of these, the ones that take the whole rest of the page where they are not closed.
ENDLESS = frozenset("script style noscript textarea title iframe".split())
#: Elements whose ids are made from titles, so that parts of an id say nothing.
TITLED = frozenset("section h1 h2 h3 h4 h5 h6".split())
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary
    table tbody td tfoot th thead tr ul""".split()
)
ARTICLE = {"main": 1, "article": 2}
DROPPED = frozenset("nav footer aside form menu button dialog search head fieldset label".split())
ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert alertdialog menu menubar".split())
NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar menu nav
    navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices notification popup
    modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations comment
    comments respond disqus replies reply widget widgets pagination pager login search toolbar skip print hidden""".split()
)
#: Whole class names and ids (fixed values) that say what an element is wherever it stands; headings and articles aside.
SURE = frozenset(
    """ad ads advert adverts advertisement adsbygoogle sponsored sidebar comments comment-list commentlist comment-section
    comments-area user-comments reader-comments disqus_thread respond reply-form newsletter newsletter-signup cookie-notice
    cookie-banner cookie-consent cookiebar gdpr-notice related-posts related-articles share-buttons social-share
    breadcrumbs pagination""".split()
)
#: Elements that are parts of a running text.
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p li blockquote pre td th dd dt figcaption caption".split())
_SURE_ON = frozenset("div section ul ol aside p span table".split())
_OUTER = frozenset("header topbar".split())
#: Elements that end an open one of the same kind, and where the search for it stops.
CLOSES = {
    "p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
LIMITS = frozenset("ul ol dl table div article section main body blockquote aside nav form td th".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_P_ENDERS = BLOCK - {"body", "html", "head"}


class Frame:
    """An open element: name, path, whether it is dropped, inside ``main`` (1) or an article (2), inside a link; number of
    the named element; steps of the path."""

    __slots__ = ("name", "path", "dropped", "article", "link", "named", "depth")

    def __init__(self, name, path, dropped, article, link, named, depth=0):
        self.name, self.path, self.dropped, self.article, self.link = name, path, dropped, article, link
        self.named, self.depth = named, depth


def _attributes(source: str) -> dict[str, str]:
    return {n.lower(): unescape((v or "").strip("\"'")) for n, v in _ATTRIBUTE.findall(source)}


@lru_cache(maxsize=4096)
def _kind(name: str, source: str) -> tuple[str, bool, bool, bool]:
    """Step of the path, whether the element is dropped anywhere, whether only outside of articles, whether by its name."""
    given = _attributes(source) if source.strip(" /") else {}
    classes = given.get("class", "")
    own = given.get("id", "")
    parts = {p.lower() for p in _PART.findall(classes if name in TITLED else f"{classes} {own}")} | {own.lower()}
    dropped = (
        name in DROPPED
        or given.get("role", "") in ROLES
        or "hidden" in given
        or given.get("aria-hidden") == "true"
        or "display:none" in given.get("style", "").replace(" ", "")
        or (name in _SURE_ON and not SURE.isdisjoint([*classes.lower().split(), own.lower()]))
    )
    named = bool(parts & NAMES) and name not in ("html", "body", "article", "main")
    step = name + "".join("." + re.sub(r"\d+", "#", c) for c in sorted(set(classes.split())))
    return step, dropped, name == "header" or bool(parts & _OUTER), named


def blocks(html: str | None):
    """(paths, blocks): how often each element path opens; (path, text, dropped, article, link letters) of each block.

    Inside an article a name alone drops nothing: its element must hold more letters in links than others.
    """
    html = html or ""
    root = Frame("", "", False, 0, False, 0)
    stack, paths, out = [root], Counter(), []
    held: list[str] = []
    linked, at, named_elements = 0, 0, 0
    unclosed: set[str] = set()
    letters: dict[int, list[int]] = defaultdict(lambda: [0, 0])

    def flush():
        nonlocal linked
        text = " ".join("".join(held).split())
        if text:
            frame = next((f for f in reversed(stack) if f.name in BLOCK), stack[-1])
            own = min(linked, len(text))
            out.append((frame.path, text, stack[-1].dropped, stack[-1].article, own, stack[-1].named))
            letters[stack[-1].named][0] += len(text)
            letters[stack[-1].named][1] += own
        held.clear()
        linked = 0

    def say(piece):
        nonlocal linked
        if piece:
            text = unescape(piece)
            held.append(text)
            if stack[-1].link:
                linked += len(text)

    def drop_to(depth):
        above = stack[depth - 1]
        if any(f.name in BLOCK or f.dropped != above.dropped or f.named != above.named for f in stack[depth:]):
            flush()
        del stack[depth:]

    end = len(html)
    while at < end:
        found = _TAG.search(html, at)
        if not found:
            say(html[at:])
            break
        say(html[at : found.start()])
        at = found.end()
        closing, name, rest = found.groups()
        if name is None:
            if found.group().startswith("<![CDATA["):
                held.append(found.group()[9:-3])
            continue
        name = name.lower()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    drop_to(depth)
                    break
            else:
                if name in BLOCK:
                    flush()
            continue
        if name in RAW:
            if not rest.rstrip().endswith("/") and name not in unclosed:
                close = re.compile(rf"</{name}\s*>", re.I).search(html, at)
                if close:
                    at = close.end()
                elif name in ENDLESS:
                    at = end
                else:
                    unclosed.add(name)
            continue
        if name == "br":
            held.append("\n")
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        ends = CLOSES.get(name, ()) + (("p",) if name in _P_ENDERS else ())
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in ends:
                drop_to(depth)
                break
            if stack[depth].name in LIMITS:
                break
        step, dropped, outer, by_name = _kind(name, rest)
        above = stack[-1]
        article = max(above.article, ARTICLE.get(name, 0))
        named = above.named
        if by_name and above.article and not named:
            named_elements += 1
            named = named_elements
        deeper = name in BLOCK and above.depth < DEPTH
        frame = Frame(
            name,
            f"{above.path}>{step}" if deeper else above.path,
            above.dropped or dropped or ((outer or by_name) and not above.article),
            article,
            above.link or name == "a",
            named,
            above.depth + deeper,
        )
        if name in BLOCK or frame.dropped != above.dropped or frame.named != above.named:
            flush()
            if name in BLOCK:
                paths[frame.path] += 1
        stack.append(frame)
    flush()
    menus = {n for n, (all_, own) in letters.items() if n and 2 * own > all_}
    return paths, [(*b[:2], b[2] or b[5] in menus, *b[3:5]) for b in out]


def host(url: str | None) -> str:
    found = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found.group(1).lower() if found else ""


def _key(path: str, text: str | None = None) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(path if text is None else f"{path}\n{text}", seed=1 if text is None else 2) >> 1


#: One row for each token of a host: its path, its text's key (null: an element), and its vector in short.
TOKENS = "host string, path string, text_key long, pages long, times long, vector long, letters long"


def tokens(pages: DataFrame) -> DataFrame:
    """The tokens of every host with their folded occurrence vectors; ``pages``: page_id, url, html."""

    def whole(batch: pa.RecordBatch) -> dict:
        """The page's host, and a key of its whole text outside of what is dropped."""
        names, keys = [], []
        for url, html in zip(*[c.to_pylist() for c in batch.columns]):
            _, found = blocks(html)
            names.append(host(url))
            keys.append(_key("", "\n\n".join(b[1] for b in found if not b[2])))
        return {"host": names, "page": keys, "html": batch.column(1)}

    def work(batch: pa.RecordBatch) -> dict:
        from xxhash import xxh64_intdigest

        sums: dict[tuple, list[int]] = defaultdict(lambda: [0, 0, 0, 0])
        sizes: Counter = Counter()
        for name, page, html in zip(*[c.to_pylist() for c in batch.columns]):
            paths, found = blocks(html)
            sizes[name] += 1
            counts: Counter = Counter({(path, None): n for path, n in paths.items()})
            letters: Counter = Counter()
            for path, text, dropped, _, linked in found:
                token = path, _key(path, text)
                counts[token] += 1
                if not dropped:
                    letters[path, None] += len(text) - 2 * linked
                    letters[token] += len(text) - 2 * linked
            mark = f"{page}\n"
            for token, n in counts.items():
                own = sums[name, *token]
                own[0] += 1
                own[1] += n
                own[2] ^= xxh64_intdigest(f"{mark}{n}") >> 1
                own[3] += letters[token]
        # The token without a path counts the host's pages.
        rows = [(*token, *own) for token, own in sums.items()] + [(n, None, None, c, c, 0, 0) for n, c in sizes.items()]
        return dict(zip(("host", "path", "text_key", "pages", "times", "vector", "letters"), zip(*rows)))

    # Copies of a page say nothing of what its host repeats on different pages: one of them counts.
    named = per_batch(pages.select("url", "html"), whole, "host string, page long, html string")
    once = named.groupBy("host", "page").agg(F.min("html").alias("html"))
    made = per_batch(once, work, TOKENS)
    return made.groupBy("host", "path", "text_key").agg(
        F.sum("pages").alias("pages"), F.sum("times").alias("times"), F.bit_xor("vector").alias("vector"),
        F.sum("letters").alias("letters"),
    )


def templates(counted: DataFrame) -> DataFrame:
    """host, element_keys, text_keys, alone_keys, main: one row per host. ``alone_keys``: the texts whose element holds
    no slot text on the host and, if it is a heading, paragraph or the like, does not stand between slots either;
    ``main``: the path of the container with most text."""
    sizes = counted.where("path is null").select("host", F.col("pages").alias("size"))
    frequent = (
        counted.where("path is not null")
        .join(sizes, "host")
        .where((F.col("pages") >= SUPPORT * F.col("size")) & ((F.col("pages") >= LEAST_PAGES) | F.col("text_key").isNull()))
    )
    classes = frequent.groupBy("host", "pages", "times", "vector").agg(
        F.count(F.lit(1)).alias("n"), F.collect_list(F.struct("path", "text_key", "letters")).alias("tokens")
    )
    per_host = classes.groupBy("host").agg(F.collect_list(F.struct("n", "tokens")).alias("classes"))

    def nest(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("host", "element_keys", "text_keys", "alone_keys", "main")}
        for name, classes in zip(*[c.to_pylist() for c in batch.columns]):
            valid = [t for c in classes if c["n"] >= LEAST_TOKENS for t in c["tokens"]]
            elements = sorted((t for t in valid if t["text_key"] is None), key=lambda t: (t["path"].count(">"), t["path"]))
            nested = {""}
            for t in elements:
                if t["path"].rpartition(">")[0] in nested:
                    nested.add(t["path"])
            texts = [t for t in valid if t["text_key"] is not None]
            # A slot's letters, without those of template texts, are those of the nested element around it.
            mass: Counter = Counter()
            varying, own = Counter(), Counter()
            for t in [*(t for c in classes for t in c["tokens"] if t["text_key"] is None), *texts]:
                top = t["path"].rpartition(">")[0]
                for sums, path in ((varying, top), (own, t["path"])):
                    sums[path] += t["letters"] if t["text_key"] is None else -t["letters"]
                while top not in nested:
                    top = top.rpartition(">")[0]
                mass[top] += t["letters"] if t["text_key"] is None else -t["letters"]
            mass = Counter({path: n for path, n in mass.items() if path and n > 0})
            best = max(mass, key=lambda p: (mass[p], p), default=None)
            out["host"].append(name)
            out["element_keys"].append(sorted(_key(p) for p in nested))
            out["text_keys"].append(sorted({t["text_key"] for t in texts if t["path"].rpartition(">")[0] in nested}))
            alone = set()
            for t in texts:
                above, _, step = t["path"].rpartition(">")
                between = step.split(".")[0] in TEXTUAL and varying[above] > 0
                if own[t["path"]] <= 0 and not between:
                    alone.add(t["text_key"])
            out["alone_keys"].append(sorted(alone & set(out["text_keys"][-1])))
            out["main"].append(best)
        return out

    made = "host string, element_keys array<long>, text_keys array<long>, alone_keys array<long>, main string"
    return per_batch(per_host, nest, made)


def main_text(
    html: str | None, text_keys: frozenset[int], main: str | None, alone_keys: frozenset[int] = frozenset()
) -> str:
    """The main text of a page, given its host's template: its texts, those that stand alone, and its main element."""
    _, found = blocks(html)
    # What is not template fills slots, and of the template what stands between slots; names only judge slots.
    keyed = [(b, _key(b[0], b[1])) for b in found if not b[2]]
    within = [b for b, k in keyed if k not in alone_keys]
    slots = [b for b, k in keyed if k not in text_keys]
    # The article, where there is one; ``main`` is its container as a rule.
    chosen = [b for b in within if b[3] == 2] or [b for b in within if b[3]]
    if not chosen:
        # No article: the slots in the host's main container, else in the one with most text on this page.
        inside = lambda path, top: path == top or path.startswith(top + ">")
        chosen = [b for b in slots if main is not None and inside(b[0], main)]
        if not chosen:
            mass: Counter = Counter()
            for path, text, _, _, linked in slots:
                mass[path.rpartition(">")[0]] += len(text) - 2 * linked
            top = max(mass, key=lambda p: (mass[p], p), default="")
            chosen = [b for b in slots if inside(b[0], top) and len(b[1]) > 2 * b[4] - 1]
    return "\n\n".join(b[1] for b in chosen)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""
    pages = pages.select("page_id", "url", "html")
    found = stored(templates(tokens(pages)), "templates").select("host", "text_keys", "alone_keys", "main")
    size = found.agg(F.sum(64 + 8 * F.size("text_keys") + 8 * F.size("alone_keys") + F.coalesce(F.length("main"), F.lit(0)))).first()[0] or 0
    kind = pages.schema["page_id"].dataType.simpleString()

    def name_hosts(batch: pa.RecordBatch) -> dict:
        return {
            "page_id": batch.column(0), "url": batch.column(1), "html": batch.column(2),
            "host": [host(u) for u in batch.column(1).to_pylist()],
        }

    def work(batch: pa.RecordBatch) -> dict:
        texts = [
            main_text(h, frozenset(keys or ()), main, frozenset(alone or ()))
            for h, keys, alone, main in zip(*[batch.column(c).to_pylist() for c in ("html", "text_keys", "alone_keys", "main")])
        ]
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": list(map(len, texts))}

    named = per_batch(pages, name_hosts, f"page_id {kind}, url string, html string, host string")
    joined = named.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "host", "left")
    return per_batch(
        joined.select("page_id", "url", "html", "text_keys", "alone_keys", "main"), work, f"page_id {kind}, url string, text string, n_chars long"
    )
