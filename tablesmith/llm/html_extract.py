"""Main text of web pages: the maximum-scoring contiguous run of tokens, words scoring positive, tags negative."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Pages that the weights are fitted on, about: all labelled ones if there are no more, else a part by hash.
FIT_PAGES = 5_000

# ---- fixed values: names of HTML elements by what they are
BLOCKS = frozenset("""
    address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td
    tfoot th thead tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe textarea title".split())
BOILERPLATE = frozenset("""
    nav aside footer dialog menu button select head noscript template svg object audio video canvas
""".split())
# ---- fixed values: words in class, id or role that name what isn't the article
BOILERPLATE_WORDS = frozenset("""
    ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies
    consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login
    sidebar menu navbar navigation nav breadcrumb breadcrumbs pagination pager footer masthead toolbar comment
    comments reply replies respond disqus share sharing social related recommended recommendations widget
    contentinfo complementary search dialog form
""".split())
BOILERPLATE_STARTS = ("advert", "breadcrumb", "comment", "cookie", "newsletter", "sidebar", "sponsor", "subscri")
NOT_BOILERPLATE = frozenset("commentary commentaries commentator commentators".split())
# ---- fixed values: such names that layouts also give to what holds the article, and those of readers' texts
LAYOUT = frozenset("sidebar widget menu navbar navigation nav search overlay pagination pager".split())
REPLIES = frozenset("comment comments reply replies respond disqus".split())
# ---- fixed values: what an open element is ended by, besides its end tag
ENDS_P = BLOCKS - frozenset("body html option summary".split())
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
             "th": {"td", "th", "tr"}, "option": {"option"}}
# ---- fixed values: counts (inside, outside the article) that stand for pages seen before any others
PRIOR = {"word": (40, 4), "word a": (2, 8), "p": (20, 2), "h": (8, 2), "li": (4, 6), "a": (3, 7), "nav": (0, 10),
         "div": (2, 8), "other": (4, 4)}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)
    |<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)
    |<[!?][^>]*(?:>|\Z)""", re.S | re.X)
_NAMES = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_BESIDE = re.compile(r"\b(?:with|has|no|without)[-_]?[a-z]+")
_HIDDEN = re.compile(r"""(?<![\w-])(?:hidden(?![\w-])|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)


class Token(NamedTuple):
    """A tag or a run of text: its feature, number of words (0 for a tag), block, place, and decoded text."""

    feature: str
    words: int
    block: int
    article: bool
    dropped: bool
    text: str


def boilerplate(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is a menu, footer, notice or the like by its kind, or hidden, with all it holds."""
    if name in BOILERPLATE or name == "header" and not in_article:
        return True
    return bool(attributes) and name not in ("html", "body", "main", "article") and bool(_HIDDEN.search(attributes))


def names(name: str, attributes: str) -> frozenset[str]:
    """The words of class, id and role that name a menu, sidebar, notice, advert, comment area or the like; form."""
    if not attributes or name in ("html", "body", "main", "article"):
        return frozenset({"form"} if name == "form" else ())
    named = " ".join(m[1] for m in _NAMES.finditer(attributes)).lower()
    words = re.findall(r"[a-z]+", _BESIDE.sub("", named))  # "with-sidebar" names what stands beside a content element
    return frozenset(w for w in [*words, name] if w not in NOT_BOILERPLATE
                     and (w in BOILERPLATE_WORDS and (w != name or w == "form") or w.startswith(BOILERPLATE_STARTS)))


class Named(NamedTuple):
    """An element that ``names`` has words for: these, the number of the innermost such one around it (0: none)."""

    words: frozenset[str]
    around: int


def trust(words: frozenset[str]) -> float:
    """What a word inside a so named element counts against one outside when it is asked which hold the article."""
    if any(w in REPLIES or w.startswith("comment") for w in words):
        return 0.01
    return 1.0 if all(w in LAYOUT or w.startswith("sidebar") for w in words) else 0.1


def kind(name: str) -> str:
    """The feature of a tag: common names stand for themselves."""
    return "h" if name in ("h1", "h2", "h3", "h4", "h5", "h6") else name if name in BLOCKS or name == "a" else "other"


class OpenElements:
    """The open elements of a page, innermost last, and the places of each name and of the blocks among them: what
    an end tag or a block closes is found without a walk, so a tag costs the same at any depth."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, int]] = []  # name, whether what is inside is dropped, innermost named
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, name: str, dropped: bool, around: int) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append((name, dropped, around))

    def last(self, *names: str) -> int:
        """The place of the innermost open element with one of the names; -1 if there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def close(self, place: int) -> int:
        """Close the element at ``place`` and all inside it; how many of them are articles or main elements."""
        articles = 0
        while len(self.stack) > place:
            name = self.stack.pop()[0]
            self.places[name].pop()
            if name in BLOCKS:
                self.blocks.pop()
            articles += name in ("article", "main")
        return articles

    def ended_by(self, name: str) -> Iterator[int]:
        """Places that the start of block ``name`` closes, one after another, each looked for after the last closed."""
        # as in HTML, a block ends an svg that was left open, but for blocks in its foreignObject
        drawn = self.last("svg", "foreignobject")
        if drawn >= 0 and self.stack[drawn][0] == "svg":
            yield drawn
        if name in ENDS_P and self.blocks and self.stack[self.blocks[-1]][0] == "p":
            yield self.blocks[-1]
        if name in SAME_ENDS:
            same = self.last(*SAME_ENDS[name])
            if same > self.last("ul", "ol", "dl", "table", "select"):
                yield same


def scanned(page: str, named: list[Named], marks: list[tuple[str, int]]) -> Iterator[tuple[Token, int]]:
    """The page's tags and text runs in order, in one scan, each with the number of the innermost named element
    around it; blocks are numbered in page order. ``dropped`` is by kind here. Named elements are added to ``named``,
    main and outermost article elements with the number around them to ``marks``."""
    opened = OpenElements()
    stack = opened.stack
    block, at, article, lower = 0, 0, 0, None

    def token(feature: str, words: int, text: str) -> tuple[Token, int]:
        _, dropped, around = stack[-1] if stack else ("", False, 0)
        return Token(feature, words, block, article > 0, dropped, text), around

    def run(text: str) -> Iterator[tuple[Token, int]]:
        if text and not text.isspace():
            plain = html.unescape(text)
            feature = "word a" if any(n == "a" for n, _, _ in stack[-4:]) else "word"
            yield token(feature, len(plain.split()), plain)
        elif text:
            yield token("word", 0, " ")

    while True:
        m = _TOKEN.search(page, at)
        yield from run(page[at:m.start() if m else len(page)])
        if m is None:
            return
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = m[1] if m[2] else m[4], m[3] if m[2] else m[6]
        if name == "br":
            yield token("word", 0, " ")
        if closing:
            block += name in BLOCKS
            yield token(kind(name), 0, "")
            if (place := opened.last(name)) >= 0:
                article -= opened.close(place)
            continue
        if name in RAW and not attributes.rstrip().endswith("/"):
            if lower is None:
                lower = page.lower() if len(page.lower()) == len(page) else page
            end = lower.find(f"</{name}", at)
            close = lower.find(">", end) if end >= 0 else -1
            at = close + 1 if close >= 0 else len(page)
            continue
        if name in BLOCKS:
            block += 1
            for place in opened.ended_by(name):
                article -= opened.close(place)
        dropped = bool(stack and stack[-1][1]) or boilerplate(name, attributes, article > 0)
        around = stack[-1][2] if stack else 0
        if not dropped and (words := names(name, attributes)):
            named.append(Named(words, around))
            around = len(named) - 1
        if name in ("article", "main"):
            if not dropped and (name == "main" or not article):
                marks.append((name, around))
            article += 1
        yield Token(kind(name), 0, block, article > 0, dropped, ""), around
        if name not in VOID and not attributes.rstrip().endswith("/"):
            opened.push(name, dropped, around)


def kept_names(found: list[tuple[Token, int]], named: list[Named], marks: list[tuple[str, int]]) -> list[bool]:
    """For each named element whether what is directly in it is kept: it and all around it hold the article.

    These do: what is around the main element or the only article outside of readers' replies; and of the names
    those whose elements hold more words outside of links than the rest of the article (of the page, if nothing
    marks it), words counted by ``trust``: the elements of that name, and what is around the largest.
    """
    holds = [True] + [False] * (len(named) - 1)

    def path(n: int) -> list[int]:
        out = []
        while n:
            out.append(n)
            n = named[n].around
        return out

    def all_kept() -> list[bool]:
        kept = [True]
        for n in range(1, len(named)):
            kept.append(holds[n] and kept[named[n].around])
        return kept

    mains = [n for name, n in marks if name == "main"][:1]
    replies = [False]
    for n in range(1, len(named)):
        replies.append(replies[named[n].around] or trust(named[n].words) == 0.01)
    own = [n for name, n in marks if name == "article" and not replies[n]]
    for n in mains or (own if len(own) == 1 else []):
        for k in path(n):
            holds[k] = True
    kept = all_kept()
    marked = any(t.article and not t.dropped and kept[n] for t, n in found)
    outside, held, by_name = 0, Counter(), Counter()
    for t, n in found:
        if t.words and t.feature == "word" and not t.dropped and t.article >= marked:
            if kept[n]:
                outside += t.words
            else:
                held[n] += t.words
                by_name[named[n].words] += t.words
    if not held:
        return kept
    best = max(by_name, key=lambda words: (trust(words) * by_name[words], sorted(words)))
    if trust(best) * by_name[best] <= outside:
        return kept
    largest = max((n for n in held if named[n].words == best), key=lambda n: (held[n], -n))
    for n in [*path(largest), *(n for n in range(1, len(named)) if named[n].words == best)]:
        holds[n] = True
    return all_kept()


def tokens(page: str) -> list[Token]:
    """The page's tags and text runs in order; ``dropped`` are those in boilerplate by kind, and by name too unless
    the named element holds the article."""
    named, marks = [Named(frozenset(), 0)], []
    found = list(scanned(page, named, marks))
    if len(named) == 1:
        return [t for t, _ in found]
    kept = kept_names(found, named, marks)
    return [t if kept[n] else t._replace(dropped=True) for t, n in found]


def features_of(page: str) -> Counter:
    """Counts of (feature, whether inside the article) of a labelled page's words and tags."""
    found: Counter = Counter()
    for t in tokens(page):
        if not t.dropped and (t.words or not t.text):
            found[t.feature, t.article] += max(t.words, 1)
    return found


class Weights(NamedTuple):
    """Score of a word and of a tag by feature: on pages with an article element by place too, else without."""

    placed: dict[tuple[str, bool], float]
    plain: dict[str, float]


def weights(counts: dict[tuple[str, bool], float]) -> Weights:
    """From counts of (feature, inside): with p the share inside, smoothed by PRIOR, a word scores 0.05 to 1
    (little where words mostly lie outside) and a tag from -0.1 (inside only) to -3 (outside only)."""
    def score(feature: str, p: float) -> float:
        return 0.05 + 0.95 * p ** 3 if feature.startswith("word") else -0.1 - 2.9 * (1 - p)

    placed, plain = {}, {}
    for feature in {*PRIOR, *(f for f, _ in counts), *BLOCKS}:
        yes, no = PRIOR.get(feature, PRIOR["other"])
        seen = [counts.get((feature, inside), 0) for inside in (True, False)]
        plain[feature] = score(feature, (seen[0] + yes) / (sum(seen) + yes + no))
        # on a page that marks its article the label of a token is the mark itself; the prior only smooths it
        placed[feature, True] = score(feature, (seen[0] + yes) / (seen[0] + yes + 0.05 * no))
        placed[feature, False] = score(feature, 0.05 * yes / (seen[1] + no + 0.05 * yes))
    return Weights(placed, plain)


def main_text(page: str | None, model: Weights) -> str:
    """The text of the best region of a page: blocks in order, joined by line feeds; "" if there is none.

    One scan finds the contiguous run of tokens with the highest sum of scores (the first, if several tie).
    Menus, notices and the like, with all they hold, score nothing and are left out of the region's text; a block
    that the region touches is taken whole. A name alone doesn't drop what holds the article (``kept_names``).
    """
    if not page:
        return ""
    found = tokens(page)
    marked = any(t.article and not t.dropped for t in found)
    best, best_from, best_to, total, begin = 0.0, 0, 0, 0.0, 0
    for k, t in enumerate(found):
        w = model.placed.get((t.feature, t.article)) if marked else model.plain.get(t.feature)
        if w is None:
            w = model.placed["other", t.article] if marked else model.plain["other"]
        w = 0.0 if t.dropped else w * t.words if t.text else max(w, 0.0) if t.article and marked else w
        if total <= 0:
            total, begin = 0.0, k
        total += w
        if total > best:
            best, best_from, best_to = total, begin, k + 1
    if best <= 0:
        return ""
    inside = {t.block for t in found[best_from:best_to] if t.words and not t.dropped}
    texts: dict[int, list[str]] = {}
    for t in found:
        if t.block in inside and t.text and not t.dropped:
            texts.setdefault(t.block, []).append(t.text)
    blocks = (" ".join("".join(parts).split()) for parts in texts.values())
    return "\n".join(b for b in blocks if b)


def fit_weights(pages: DataFrame, fit_pages: int = FIT_PAGES) -> Weights:
    """Weights from labelled pages: those whose markup names exactly one article (or main) element.

    Fitted on about ``fit_pages`` of them, chosen by a hash of the page; on all if there are no more. Tasks count features; the driver gets
    at most two rows per element name of BLOCKS. Without labelled pages the fixed PRIOR counts decide alone.
    """
    lower = F.lower("html")
    once = (F.regexp_count(lower, F.lit(r"<article[\s>]")) + F.regexp_count(lower, F.lit(r"<main[\s>]"))) == 1
    labelled = pages.select("html").filter(F.col("html").isNotNull() & once)
    share = min(1.0, fit_pages / max(labelled.count(), 1))
    place = F.pmod(F.xxhash64("html"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    chosen = labelled.filter(place < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column("html"):
                total.update(features_of(page.as_py()))
        yield pa.RecordBatch.from_pydict({
            "feature": pa.array([f for f, _ in total], pa.string()), "inside": pa.array([i for _, i in total], pa.bool_()),
            "n": pa.array(list(total.values()), pa.int64())})

    rows = (chosen.mapInArrow(count, "feature string, inside boolean, n bigint")
            .groupBy("feature", "inside").agg(F.sum("n").alias("n")).collect())
    return weights({(r["feature"], r["inside"]): r["n"] for r in rows})


def extracted(page: Column, model: Weights) -> Column:
    """Column with the main text of each whole page; "" for a null or empty one. ``model`` goes along."""

    @F.pandas_udf(StringType())
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p, model) for p in batch], dtype=object)

    return extract(page)


def main_texts(pages: DataFrame, model: Weights) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row of ``pages``; repeated rows stay, other columns aren't read."""
    return (pages.select("page_id", "url", extracted(F.col("html"), model).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
