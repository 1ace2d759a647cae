"""Main text of web pages as a maximum-scoring contiguous region.

A page is read as a sequence of text runs and tags. Words score above zero,
tags below zero by a weight of their kind, and one linear scan finds the
contiguous region with the highest sum. Weights are log-odds of a tag standing
outside the article, counted on labelled pages: those of a bounded sample whose
own markup names the article (``<article>`` or ``<main>``); fixed counts serve
as prior and for collections without such pages. Words within menus, headers,
footers, sidebars, notices, adverts, forms and reader comments (by element, by
class or id, or learned: elements whose words never stood in an article) score
below zero and are left out of a region that spans them.

Scripts, styles, comments and markup are no text; an unfinished tag, comment or
script reaches to the end of the page. Character references are decoded, blocks
are joined by one space, and white space within one becomes one space. Null and
empty pages, and pages without words, have an empty text. Repeated rows give
repeated results; columns other than those named are not looked at. Time is
linear in the page.
"""

from __future__ import annotations

import html as markup
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages that training reads at most, about.
SAMPLE = 2000
#: An element is learned to be no content from so many labelled pages on.
MIN_PAGES = 20
#: Weight of what is known of an element beforehand, in occurrences.
PRIOR = 2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|select|button|object)(?![a-z0-9-])[^>]*(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:\"[^\"<]*\"|'[^'<]*'|[^>])*?)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.I | re.S,
)
_ATTR = re.compile(r"(?<![a-z-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+|[0-9]+", re.I)

# How elements are used in HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset(("article", "main"))
BOILERPLATE = frozenset("head nav footer aside form menu dialog fieldset".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar side aside footer foot masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login "
    "share sharing social related recommended comments comment commentlist disqus respond replies reply complementary contentinfo search pagination pager widget".split()
)
PRIOR_OUTSIDE = frozenset("html head body nav footer aside header form ul ol li a input label button table tr td th img link meta".split())
PRIOR_INSIDE = frozenset("p h1 h2 h3 h4 h5 h6 br b i em strong blockquote pre code span sup sub figure figcaption".split())


@dataclass
class Weights:
    word: float = 1.0
    #: Of words and tags of menus, adverts and the like, which are left out anyway: little, so that a region may span them.
    boilerplate: float = -0.1
    tags: dict[str, float] = field(default_factory=dict)
    learned_boilerplate: frozenset = frozenset()

    def tag(self, name: str, kind: str) -> float:
        w = self.tags.get(kind)
        if w is None:
            w = self.tags.get(name)
        return -2.0 if w is None else w


def _kind(name: str, attrs: str) -> tuple[str, set[str]]:
    """The element with its first class, and all parts of its class, id and role."""
    first, parts = "", set()
    if "=" in attrs:
        for m in _ATTR.finditer(attrs):
            value = m[2] or m[3] or m[4] or ""
            if m[1].lower() == "class" and not first:
                first = (value.split() or [""])[0].lower()
            parts.update(x.lower() for x in _PART.findall(value))
    return (f"{name}.{first}" if first else name), parts


class Page:
    """Runs of text and tags of a page, in order."""

    def __init__(self, source: str, weights: Weights):
        #: (text or None, element kind, element name, in boilerplate, in an article, is block)
        self.tokens: list[tuple[str | None, str, str, bool, bool, bool]] = []
        self.labelled = False
        stack: list[tuple[str, bool, bool]] = []  # name, in boilerplate, in an article
        out, inside, at = False, False, 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                self.tokens.append((source[at : m.start()], "", "", out, inside, False))
            at = m.end()
            name = m["name"]
            if name is None:
                if m["raw"]:
                    self.tokens.append((None, m["raw"].lower(), m["raw"].lower(), out, inside, True))
                continue
            name = name.lower()
            at_tag = out
            if m["close"]:
                kind = name
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
                out, inside = stack[-1][1:] if stack else (False, False)
            else:
                kind, parts = _kind(name, m["attrs"])
                if name not in VOID and not m["attrs"].endswith("/") and name not in ("p", "li", "b", "i", "em", "strong"):
                    if name in CONTENT:
                        self.labelled = True
                        out, inside = out and inside, True  # an advert left open ends where the article begins
                    elif name in BOILERPLATE or (name == "header" and not inside) or kind in weights.learned_boilerplate or (name not in ("html", "body") and parts & BOILERPLATE_NAMES):
                        out = True
                    stack.append((name, out, inside))
            self.tokens.append((None, kind, name, out or at_tag, inside, name not in INLINE))
        if at < len(source):
            self.tokens.append((source[at:], "", "", out, inside, False))

    def best(self, weights: Weights) -> tuple[int, int]:
        """The region of tokens with the highest score, the first of equals; empty if none is above zero."""
        top, best, start, score = 0.0, (0, 0), 0, 0.0
        for k, (text, kind, name, out, _, _) in enumerate(self.tokens):
            if text is None:
                score += weights.boilerplate if out else weights.tag(name, kind)
            else:
                score += len(text.split()) * (weights.boilerplate if out else weights.word)
            if score <= 0:
                score, start = 0.0, k + 1
            elif score > top:
                top, best = score, (start, k + 1)
        return best

    def text(self, region: tuple[int, int]) -> str:
        parts = []
        for text, _, _, out, _, block in self.tokens[region[0] : region[1]]:
            if text is not None:
                if not out:
                    parts.append(text)
            elif block:
                parts.append(" ")
        # a reference split by markup is none, so each run is decoded by itself
        return " ".join("".join(markup.unescape(p) if "&" in p else p for p in parts).split())


def extract_text(source: str | None, weights: Weights) -> str:
    page = Page(source or "", weights)
    return page.text(page.best(weights))


def _counted(page: Page) -> Counter:
    """Of a labelled page: tags and words by whether they stand in the article."""
    out: Counter = Counter()
    open_kinds: list[str] = []
    for text, kind, name, boiler, inside, _ in page.tokens:
        if text is None:
            if not boiler:  # tags within menus and the like say nothing about those around an article
                for k in {name, kind}:
                    out["tag", k, inside and name not in CONTENT] += 1
            open_kinds = [kind]
        elif text.strip():
            out["words", open_kinds[-1] if open_kinds else "", inside] += len(text.split())
    return out


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> Weights:
    """Weights from a sample of the labelled pages, about ``sample`` of them, chosen by a hash of the id."""
    rows = pages.select(F.col(id_col).alias("i"), F.col(html_col).alias("html")).filter(F.col("html").rlike("(?i)<(article|main)[ >]"))
    total = rows.count()
    span = 1 << 30
    chosen = rows.filter(F.pmod(F.xxhash64(F.col("i"), F.lit("page sample")), F.lit(span)) < int(min(1.0, sample / max(total, 1)) * span)).select("html")

    def run(batches):
        plain = Weights()
        total: Counter = Counter()
        on: Counter = Counter()
        for batch in batches:
            for source in batch.column(0).to_pylist():
                page = Page(source, plain)
                if page.labelled:
                    got = _counted(page)
                    total += got
                    on.update({(what, k) for what, k, _ in got})
        if total:
            keys = list(total)
            yield pa.RecordBatch.from_pydict({
                "what": [k[0] for k in keys], "kind": [k[1] for k in keys], "inside": [k[2] for k in keys],
                "n": pa.array([total[k] for k in keys], pa.int64()), "pages": pa.array([on[k[:2]] for k in keys], pa.int64()),
            })

    counted = chosen.mapInArrow(run, "what string, kind string, inside boolean, n bigint, pages bigint")
    summed = counted.groupBy("what", "kind", "inside").agg(F.sum("n").alias("n"), F.sum("pages").alias("pages"))
    return learn([tuple(r) for r in summed.collect()])  # bounded by the sample


def learn(counts: list[tuple[str, str, bool, int, int]]) -> Weights:
    inside: Counter = Counter({k: PRIOR for k in PRIOR_INSIDE})
    outside: Counter = Counter({k: PRIOR for k in PRIOR_OUTSIDE})
    words_in: Counter = Counter()
    words_out: Counter = Counter()
    seen: Counter = Counter()
    for what, kind, within, n, pages in counts:
        if what == "tag":
            (inside if within else outside)[kind] += n
        else:
            (words_in if within else words_out)[kind] += n
            seen[kind] = max(seen[kind], pages)
    tags = {k: -max(0.05, math.log((outside[k] + 1) / (inside[k] + 1)) * 2) for k in {*inside, *outside}}
    learned = frozenset(k for k in words_out if seen[k] >= MIN_PAGES and "." in k and not words_in[k])
    return Weights(tags=tags, learned_boilerplate=learned)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", weights: Weights | None = None) -> DataFrame:
    """One row per page: id, url, text, n_chars (code points)."""
    sent = weights or fit(pages, id_col, html_col)

    def run(batches):
        for batch in batches:
            texts = [extract_text(x, sent) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_pydict({"page": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    kinds = dict(pages.dtypes)
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    out = rows.mapInArrow(run, f"page {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars bigint")
    return out.select(F.col("page").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
