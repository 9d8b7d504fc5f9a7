"""Main text of web pages by consensus host paths (operator 7).

1. In tasks, every page is cut into blocks of text, each with the generalised path of its
   container (tags with their first class, digits as ``#``).  Blocks in menus, forms and the
   like (by tag, role or style) are marked.  Where only class or id words say so, the container
   is marked unless it has ``LARGE`` times the unlinked text of what is not marked around it, so
   an article in a badly named container stays and takes part in the votes.  The others give their length, less twice that of links,
   to their container and half of it to the one above; the best container is the page's vote.
2. Spark adds the votes up by host and path (pre-aggregated in tasks, so a host with a third
   of all pages is no hot key).  Paths with a tenth of their host's votes win, ten at most.
3. Every page is extracted again with the first of its host's winning paths that it has;
   a page that has none of them uses its own best container.

Blocks: white space is one blank, entities are decoded, ``<br>`` is white space, blocks are
joined in page order by a line feed.  Nothing else is dropped or cut.

Defined cases: a null or empty html, and a page with nothing but marked (and no large) blocks, gives an
empty text; pages without a usable url are one host; unclosed tags, comments and scripts
run to where HTML closes them or to the end; containers deeper than ``DEEPEST`` count as
their ancestor there; equal rows give equal rows; other columns pass through.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, hide, join_lookup, restore, steps

#: Share of a host's votes from which on a path wins.
WINNING_SHARE = 0.1
DEEPEST = 64
#: A container that class words mark stays if it has so many characters, and so many times the text around it.
LEAST = 200
LARGE = 4

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes title textarea".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("caption head html tbody td tfoot th thead tr".split())
#: What an opening tag closes first, up to the elements that hold it.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
#: A paragraph is not closed from inside these.
HOLDS = frozenset("table td th caption button object template html".split())
#: Elements that are no part of an article, and class or id words that say so.
MARKED_TAGS = frozenset(
    "head nav footer aside form script style noscript template button select iframe object svg canvas audio video "
    "dialog menu textarea title noembed noframes input label datalist map".split())
MARKED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle adslot adbox sponsor sponsored sponsors promo "
    "promos promoted promotion banner banners sidebar sidebars sidenav nav navbar navigation menu menus breadcrumb "
    "breadcrumbs footer footers header headers masthead topbar comment comments commentlist disqus respond reply "
    "replies discussion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations widget widgets toolbar "
    "pagination pager skip skiplink hidden".split())
MARKED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar toolbar form".split())
#: Words that turn the words beside them in a class around, and layout words, whose widgets hold anything.
NEGATED = frozenset("has no not with without".split())
LAYOUT = frozenset("container wrapper wrap layout".split())
#: Words beside ``header`` that make it the article's own.
OWN_HEADER = frozenset("article entry post story content".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|"
    r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"'>]+)")
WANTED = re.compile(r"class|id|role|hidden|style", re.I)
WORDS = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])|(?<=[A-Za-z])(?=[0-9])")
DIGITS = re.compile(r"[0-9]+")


def _attributes(text: str) -> dict[str, str]:
    if not WANTED.search(text):
        return {}
    return {(m[1] or m[5]).lower(): entities.unescape(m[2] or m[3] or m[4] or "")
            for m in reversed(list(ATTRIBUTE.finditer(text)))}


def _marked(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in MARKED_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(
            r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return True
    if attributes.get("role", "").lower() in MARKED_ROLES:
        return True
    return False


def _suspect(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether class or id words mark the element."""
    if not attributes or tag in ("html", "body"):
        return False
    words: set[str] = set()
    found: set[str] = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        own = {w.lower() for w in WORDS.split(name)}
        words |= own
        if not own & NEGATED:
            found |= (own & MARKED_WORDS) - ({"widget", "widgets"} if own & LAYOUT else set())
    return bool(found) and not (found <= {"header", "headers"} and (in_article or words & OWN_HEADER))


Suspects = tuple[str, ...]


def _cleared(found: list[tuple[str, str, int, Suspects]]) -> list[tuple[str, str, int]]:
    """The blocks without those in suspect containers, unless these are large beside the rest."""
    own: defaultdict[Suspects, int] = defaultdict(int)
    inside: defaultdict[Suspects, int] = defaultdict(int)
    for _, text, links, chain in found:
        worth = max(0, len(text) - 2 * links)
        own[chain] += worth
        for k in range(len(chain)):
            inside[chain[:k + 1]] += worth
    # text that is not marked, of the container and those above it; -1 is a marked container
    rest = {(): own[()]}
    for chain in sorted(inside, key=len):
        around = rest[chain[:-1]]
        stays = around >= 0 and inside[chain] >= max(LEAST, LARGE * around)
        rest[chain] = around + own[chain] if stays else -1
    return [(path, text, links) for path, text, links, chain in found if rest[chain] >= 0]


def blocks(page: str | None) -> list[tuple[str, str, int]]:
    """(path of the container, text, characters in links) of each block that is not marked."""
    out: list[tuple[str, str, int, Suspects]] = []
    page = page or ""
    # open elements: (tag, path of the container in it, marked, inside an article, suspect containers)
    stack: list[tuple[str, str, bool, bool, Suspects]] = [("", "", False, False, ())]
    opened: defaultdict[str, int] = defaultdict(int)
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            if joined := " ".join("".join(text).split()):
                # a paragraph is a block of the container that holds it
                out.append((stack[-1][1], joined, min(linked, len(joined)), stack[-1][4]))
            text.clear()
            linked = 0

    def pop_to(tags: set[str] | frozenset[str], stop: set[str] | frozenset[str]) -> bool:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                break
            if stack[k][0] in stop:
                return False
        else:
            return False
        if any(x[0] in BLOCK for x in stack[k:]):
            flush()
        for x in stack[k:]:
            opened[x[0]] -= 1
        del stack[k:]
        return True

    def add(chunk: str) -> None:
        nonlocal linked
        if chunk and not stack[-1][2]:
            text.append(chunk)
            if opened["a"]:
                linked += len(chunk)

    at = 0
    size = len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            add(entities.unescape(page[at:]))
            break
        add(entities.unescape(page[at:m.start()]))
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if opened[tag]:
                pop_to({tag}, frozenset())
            continue
        if tag in BLOCK and opened["p"] and tag in CLOSES_P:
            pop_to({"p"}, HOLDS)
        if tag in IMPLIED:
            closes, holds = IMPLIED[tag]
            while any(opened[x] for x in closes) and pop_to(closes, holds):
                pass
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCK:
            flush()
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else size
            if end:   # its closing tag ends it
                close = page.find(">", at)
                at = size if close < 0 else close + 1
            continue
        _, path, marked, in_article, chain = stack[-1]
        found = _attributes(attributes) if attributes.strip() else {}
        suspect = _suspect(tag, found, in_article)
        marked = marked or _marked(tag, found, in_article) or (suspect and tag not in BLOCK)
        if tag in BLOCK and tag != "p" and not re.fullmatch("h[1-6]", tag) and path.count(">") < DEEPEST:
            first = found.get("class", "").split()[:1]
            path = f"{path}>{tag}" + (f".{DIGITS.sub('#', first[0])}" if first else "")
        if suspect and len(chain) < DEEPEST:
            chain = (*chain, path)
        stack.append((tag, path, marked, in_article or tag == "article", chain))
        opened[tag] += 1
    flush()
    return _cleared(out)


ARTICLE = re.compile(r"^((?:.*?)>article(?:\.[^>]*)?)(?:>|$)")
MAIN = re.compile(r"^((?:.*?)>main(?:\.[^>]*)?)(?:>|$)")


def best_path(found: list[tuple[str, str, int]]) -> tuple[str, float] | None:
    """The page's best container and its share of the page's score."""
    score: defaultdict[str, float] = defaultdict(float)
    for path, text, links in found:
        worth = max(0, len(text) - 2 * links) + 5 * text.count(",")
        score[path] += worth
        above = path.rpartition(">")[0]
        if above:
            score[above] += worth / 2
    if not score:
        return None
    best = min(score, key=lambda p: (-score[p], p))
    for holder in (ARTICLE, MAIN):   # an article is taken whole
        if m := holder.match(best):
            return m[1], score[best] / (sum(score.values()) or 1)
    return best, score[best] / (sum(score.values()) or 1)


def extract(found: list[tuple[str, str, int]], winners: list[str]) -> str:
    """The text of the blocks under the first winning path that the page has."""
    own = best_path(found)
    for path in [*winners, *([own[0]] if own else [])]:
        if taken := [text for p, text, _ in found if p == path or p.startswith(f"{path}>")]:
            return "\n".join(taken)
    return ""


HOST = r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def _hosted(pages: DataFrame, url: str) -> DataFrame:
    return pages.withColumn("_host", F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), HOST, 1))


def host_paths(pages: DataFrame, html: str = "html", url: str = "url",
               share: float = WINNING_SHARE) -> DataFrame:
    """(_host, paths): the winning container paths of each host, most votes first."""
    narrow = _hosted(pages.select(F.col(url).alias("url"), F.col(html).alias("html")), "url").select("_host", "html")
    schema = T.StructType([T.StructField("_host", T.StringType()), T.StructField("path", T.StringType()),
                           T.StructField("votes", T.DoubleType())])

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "html"):
            votes: defaultdict[tuple[str, str], float] = defaultdict(float)
            for host, page in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                if best := best_path(blocks(page)):
                    votes[host, best[0]] += best[1]
            if votes:
                yield pa.RecordBatch.from_arrays([
                    pa.array([k[0] for k in votes], pa.string()), pa.array([k[1] for k in votes], pa.string()),
                    pa.array(list(votes.values()), pa.float64())], names=["_host", "path", "votes"])

    votes = narrow.mapInArrow(vote, schema).groupBy("_host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"))
    total = votes.groupBy("_host").agg(F.sum("votes").alias("all"))
    won = votes.join(total, "_host").filter(F.col("votes") >= share * F.col("all"))
    return won.groupBy("_host").agg(F.transform(
        F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path"))), lambda x: x.path).alias("paths"))


def main_text(pages: DataFrame, html: str = "html", url: str = "url", out: str = "text",
              paths: DataFrame | None = None) -> DataFrame:
    """``pages`` without ``html``, with the main text of each page."""
    paths = cut(host_paths(pages, html, url)) if paths is None else paths
    pages, names = hide(pages.drop(*[out] if out not in (html, url) else []))
    html, url = names.pop(html), names[url]
    joined = join_lookup(_hosted(pages, url), paths, "_host").drop("_host")
    kept = [f for f in pages.schema.fields if f.name != html]
    schema = T.StructType([*kept, T.StructField("_text", T.StringType())])
    fields = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, html):
            have = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            texts = [extract(blocks(page), won or [])
                     for page, won in zip(have[html].to_pylist(), have["paths"].to_pylist(), strict=True)]
            have["_text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([have[n] for n in fields], names=fields)

    return restore(joined.mapInArrow(run, schema), names | {out: "_text"})
