"""Main text of web pages by consensus of their host.

1. Every page is parsed once; its containers are scored by the text they hold
   (little for link text), and the page votes for the generalised path (tags
   and classes from the root, digits folded) of its best container.
2. Votes are added up by host and path in Spark, with map-side combine.
3. Every page is extracted again with its host's winning paths: the first one
   that the page has text in.  A page with none of them uses its own best.

Only paths with at least a tenth of their host's votes win, so a host has at
most ten.  The parser keeps no tree: it walks over the tags with a stack.

An element whose class, id or role names what others wrote or sell (reader
comments, adverts, notices) is left out however much it holds, unless it holds
the page's only article.  One that names other clutter, and a form, is left
out when it holds under half of the page's unlinked text and no article or
main element; one that stays counts ``MARKED`` of its score.  If the latter
leave a page without text, they stay.  A page takes time in proportion to its
length, tidy or not.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.tables import pylist_batches, written

SHARE = 0.1
MARKED = 0.25
BROADCAST_HOSTS = 50_000

# Elements by their part in a page.
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "xmp")
SKIP = frozenset("head nav footer aside button select dialog menu object audio video canvas map".split()) \
    | frozenset(RAW)
BLOCK = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption address header hgroup form fieldset details summary center hr".split()) | SKIP
VOID = frozenset("br hr img meta link input area base col embed source track wbr param".split())
KEEP_CLASS = frozenset(("html", "body", "article", "main"))
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "body": ("head",)}
SCOPE = frozenset(("table", "td", "th", "ul", "ol", "dl", "article", "body", "html"))
# Words of class, id and role names that mark what is not the article.
CLUTTER = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs footer sidebar aside ad ads advert adverts advertisement "
    "adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended comment comments reply replies "
    "disqus respond discussion pagination pager search searchbox toolbar widget widgets skip print complementary "
    "contentinfo masthead".split())
# Of these, words of what others wrote or sell: out however much text it holds.
FOREIGN = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "alert popup modal overlay comment comments reply replies disqus respond discussion".split())
LAYOUT = frozenset(("no", "has", "with", "without"))         # no-sidebar, has-ads: about the page, not the element
STATE = frozenset("open closed enabled disabled on off allowed".split())     # comments-open: likewise
HEADER = frozenset(("header", "topbar", "masthead"))
ARTICLE_WORDS = frozenset("article post entry content story main page".split())

# A tag ends before the next "<" and a quoted value after 2,000 characters, so a page of broken tags takes linear time.
_VALUES = r"(?:[^<>\"']|\"[^\"]{0,2000}\"|'[^']{0,2000}')*"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(" + "|".join(RAW) + rf")(?=[\s/>]){_VALUES}>.*?(?:</\1(?=[\s/>])[^<>]*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/<>]*)({_VALUES})>|</?[a-zA-Z][^<>]*>|<[!?/][^<>]*>", re.S | re.I)
MAX_DEPTH = 64              # containers inside deeper ones count as part of them
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class _Names(dict):
    """What an element's attributes say, by its raw attribute text:
    (first class, digits folded; words of class, id and role; whether they
    name something foreign to the article and nothing of it)."""

    def __missing__(self, raw: str) -> tuple[str, frozenset, bool]:
        first, words, foreign, own = "", set(), False, False
        for name, a, b, c in _NAMES.findall(raw):
            value = a or b or c
            if name.lower() == "class" and value.split() and not first:
                first = re.sub(r"[0-9]+", "#", value.split()[0].lower())
            for one in value.split():
                said = [w.lower() for w in _WORDS.findall(one)]
                if STATE.isdisjoint(said):
                    said = said[:next((k for k, w in enumerate(said) if w in LAYOUT), len(said))]
                    words.update(said)
                    foreign |= not FOREIGN.isdisjoint(said)
                    own |= not ARTICLE_WORDS.isdisjoint(said) and CLUTTER.isdisjoint(said)
        if len(self) > 20_000:
            self.clear()
        self[raw] = first, frozenset(words), foreign and not own
        return self[raw]


def blocks(page: str, names: _Names) -> list[tuple[tuple[str, ...], str, int, bool]]:
    """The page's text blocks in order, clutter left out: (paths of all open
    containers, outermost first; text; characters of it inside links; whether
    an element that names clutter holds it)."""
    out: list[tuple[tuple[str, ...], str, int, tuple[int, ...]]] = []
    stack: list[tuple[str, str, bool, tuple[int, ...]]] = [("", "", False, ())]   # tag, path, in clutter, marked elements
    holds: list[bool] = []                                   # whether each marked element holds an article
    foreign: list[bool] = []                                 # whether it is foreign to the article
    free, beyond = False, 0                                  # an article outside foreign elements; containers not opened
    open_tags: Counter = Counter()
    paths: tuple[str, ...] = ("",)
    text: list[str] = []
    linked, in_link, in_article, at = 0, False, 0, 0

    def end_block() -> None:
        nonlocal text, linked
        if text:
            whole = " ".join("".join(text).split())
            if whole:
                out.append((paths, whole, min(linked, len(whole)), stack[-1][3]))
            text, linked = [], 0

    def pop_to(depth: int) -> None:
        nonlocal paths, in_article
        end_block()
        in_article -= sum(tag in ("article", "main") for tag, *_ in stack[depth:])
        open_tags.subtract(tag for tag, *_ in stack[depth:])
        del stack[depth:]
        paths = tuple(dict.fromkeys(path for _, path, *_ in stack))

    def add(chunk: str) -> None:
        nonlocal linked
        if chunk and not stack[-1][2]:
            chunk = htmllib.unescape(chunk) if "&" in chunk else chunk
            text.append(chunk)
            if in_link:
                linked += len(chunk)

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                add(htmllib.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if m[2]:
            if tag == "a":
                in_link = False
            if beyond and (tag in BLOCK or not open_tags[tag]):
                end_block()
                beyond -= tag in BLOCK
                continue
            for depth in range(len(stack) - 1, 0, -1) if open_tags[tag] else ():
                if stack[depth][0] == tag:
                    pop_to(depth)
                    break
                if stack[depth][0] in SCOPE and tag not in BLOCK:
                    break
            continue
        if tag == "br":
            if text:
                text.append(" ")
            continue
        if tag == "a":
            in_link = True
        first, words, alien = names[m[4]] if m[4] else ("", frozenset(), False)
        block = tag in BLOCK
        clutter = tag in SKIP or (tag == "header" and not in_article)
        alien = alien and tag not in ("html", "body", "main")
        marked = alien or tag == "form" or tag not in KEEP_CLASS and not clutter and bool(
            words & CLUTTER or (not in_article and words & HEADER and not words & ARTICLE_WORDS))
        if block:
            # a block ends an open paragraph; list items, rows and cells end their like
            ends = CLOSES.get(tag, ())
            for depth in range(len(stack) - 1, 0, -1) if any(open_tags[t] for t in ("p", *ends)) else ():
                if stack[depth][0] == "p" or stack[depth][0] in ends:
                    pop_to(depth)
                elif stack[depth][0] in SCOPE or stack[depth][0] not in BLOCK:
                    break
            end_block()
        if (block or clutter or marked) and tag not in VOID and not m[4].endswith("/"):
            end_block()
            if len(stack) > MAX_DEPTH:
                beyond += tag in BLOCK
                continue
            label = f"{tag}.{first}" if first else tag
            path = stack[-1][1] if tag == "p" else label if tag in ("html", "body") else f"{stack[-1][1]}>{label}"
            marks = stack[-1][3]
            if tag in ("article", "main"):
                in_article += 1
                if not words & CLUTTER:                     # a comment may be an article element too
                    free |= not any(foreign[k] for k in marks)
                    for k in marks:
                        holds[k] = True
            if marked:
                marks = (*marks, len(holds))
                holds.append(False)
                foreign.append(alien)
            open_tags[tag] += 1
            stack.append((tag, path, clutter or stack[-1][2], marks))
            paths = tuple(dict.fromkeys(path for _, path, *_ in stack))
    if at < len(page):
        rest = page[at:]
        cut = re.search(r"<[a-zA-Z/!][^<]*\Z", rest)            # a tag that the page's end cut off
        add(rest[:cut.start()] if cut else rest)
    end_block()
    if not holds:
        return [(*b[:3], False) for b in out]
    # what is foreign goes, unless it holds the page's only article
    gone = {k for k, alien in enumerate(foreign) if alien and (free or not holds[k])}
    return unmarked([b for b in out if gone.isdisjoint(b[3])], holds)


def unmarked(found: list, holds: list[bool]) -> list[tuple[tuple[str, ...], str, int, bool]]:
    """Blocks (with the marked elements around each) without those in a marked
    element that is clutter, as it holds no article and under half of the
    unlinked text; all of them if none is left."""
    own, total = [0] * len(holds), 0
    for _, text, linked, marks in found:
        total += len(text) - linked
        for k in marks:
            own[k] += len(text) - linked
    clutter = {k for k, held in enumerate(holds) if not held and 2 * own[k] < max(total, 1)}
    left = [b for b in found if clutter.isdisjoint(b[3])] or found
    return [(*b[:3], bool(b[3])) for b in left]


def container_scores(found: list) -> dict[str, float]:
    """Score by container path: the text of a block that is no link counts
    fully for the container that holds it, half for the next one out, and so
    on; commas and sentences add to it, a name of clutter takes from it."""
    scores: dict[str, float] = {}
    for paths, text, linked, marked in found:
        value = len(text) - 2.0 * linked + 10 * (text.count(",") + text.count(". "))
        value *= MARKED if marked and value > 0 else 1
        for path in reversed(paths):
            scores[path] = scores.get(path, 0.0) + value
            value /= 2
    return scores


def best_path(found: list) -> str | None:
    """The path of the best container; the article (or main) element around
    it, if there is one, as that holds the headline too."""
    scores = container_scores(found)
    if not scores:
        return None
    steps = max(scores, key=lambda p: (scores[p], p)).split(">")
    for kind in ("article", "main"):
        for k in range(len(steps), 0, -1):
            if steps[k - 1].partition(".")[0] == kind:
                return ">".join(steps[:k])
    return ">".join(steps)


def text_under(found: list, path: str) -> str:
    return "\n".join(text for paths, text, *_ in found if path in paths)


def extract(page: str, winners: list[str], names: _Names | None = None) -> tuple[str, str | None]:
    """(main text, path used) of one page."""
    found = blocks(page, _Names() if names is None else names)
    for path in [*winners, best_path(found)]:
        if path is not None and (text := text_under(found, path)):
            return text, path
    return "", None


def host_column(url: str = "url") -> F.Column:
    """Host of a url, lower case, without ``www.`` and port; '' if none."""
    address = F.lower(F.coalesce(F.col(url).cast("string"), F.lit("")))
    return F.regexp_extract(address, r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?(?:www\.)?([^/:?#]+)", 1)


def winners(pages: DataFrame) -> DataFrame:
    """``host`` and its winning ``paths``, most votes first."""
    def vote(batches):
        names = _Names()
        for batch in batches:
            for part in pylist_batches(batch, "html"):
                best = [best_path(blocks(h, names)) for h in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best, pa.string())], ["host", "path"])
    rows = pages.select(host_column().alias("host"), F.col("html").cast("string").alias("html")) \
        .where("host <> '' and html is not null")
    votes = rows.mapInArrow(vote, "host string, path string").where("path is not null") \
        .groupBy("host", "path").agg(F.count("*").alias("votes"))
    # a host may have very many paths: only those with their share of the votes come together
    votes = written(votes, "html-votes")
    totals = votes.groupBy("host").agg(F.sum("votes").alias("all"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path")))
    return votes.join(totals, "host").where(F.col("votes") >= SHARE * F.col("all")) \
        .groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("paths"))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` and the ``path`` used, for every row.

    A null or empty html and a page without text give an empty text.  Pages
    without a host neither vote nor follow a vote.  Repeated rows vote and are
    extracted as often as they come; a tie of votes goes to the first path in
    order; an empty table gives no rows; other columns are ignored.
    """
    won = written(winners(pages), "html-winners")
    if won.count() <= BROADCAST_HOSTS:               # at most ten short paths a host
        won = F.broadcast(won)
    rows = pages.select(F.col("page_id"), F.col("url"), host_column().alias("host"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")) \
        .join(won, "host", "left").select("page_id", "url", "html", "paths")

    def run(batches):
        names = _Names()
        for batch in batches:
            for part in pylist_batches(batch, "html"):
                pages_, paths = part.column(2).to_pylist(), part.column(3).to_pylist()
                out = [extract(h, p or [], names) for h, p in zip(pages_, paths)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([t for t, _ in out], pa.string()),
                     pa.array([len(t) for t, _ in out], pa.int64()), pa.array([p for _, p in out], pa.string())],
                    ["page_id", "url", "text", "n_chars", "path"])

    kinds = dict(pages.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, path string")
