"""Main text of web pages by host paths that the pages of a host agree on.

Each page is read once to find its best container, the deepest element that holds most of the page's running
text and leaves out only text that is mostly links, never inside an article or main element. It votes for its
generalised path (tags and classes with digits folded). Spark counts the votes of each host. Pages are then read
again with the winning path of their host; a page without that path, or where it would leave out more than text of
links, uses its own best container.

Blocks are joined by line ends; a block's white space is single blanks, character references are decoded. Menus,
headers, footers, sidebars, notices, adverts, forms and their controls, scripts, styles, drawings, frames and reader
comments are left out by their tags, roles and class words. Such an element that is never closed ends at the next end
of a block.

Null html and pages without text give an empty text. A url without a host votes among the pages without one;
null ids and repeated rows are kept. An empty table gives no row.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from traceops.llm.storage import checkpointed
from traceops.llm.text import parts, picked, strings
from traceops.llm.url_filter import host_of

#: Winners of so many hosts are broadcast, a few megabytes; beyond, they are joined by a salted shuffle.
BROADCAST_HOSTS = 50_000
SALTS = 32
#: A container is chosen where it holds this share of a page's running text.
SHARE = 0.7
#: Text is mostly links with no more than this share of it outside them.
PLAIN_SHARE = 0.5

_BLOCK_END = r"</(?:p|div|article|section|main|body|html|td|th|tr|table|li|ul|ol|dd|dl|figure|blockquote|pre|h[1-6])\b"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(script|style|textarea|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:/>|>.*?(?:</\1\s*>|$))"
    r"|<(noscript|template|svg|iframe|select)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:/>|>(?:(?:(?!<\2\b).)*?</\2\s*>|.*?(?:(?=" + _BLOCK_END + r")|$)))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S | re.I)
_UNFINISHED = re.compile(r"</?[a-zA-Z][^<>]*$")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_DIGITS = re.compile(r"\d+")
# fixed values of the HTML format
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q "
                    "ruby rt rp s samp small span strike strong sub sup time tt u var wbr meta link base source "
                    "math semantics annotation mrow mi mn mo ms mtext mspace mfrac msqrt mroot msub msup msubsup munder mover munderover "
                    "mfenced menclose mstyle mpadded mphantom merror mtable mtr mtd".split())
_CONTAINERS = frozenset("body article main section div td".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "option": {"option"}}
_LEFT_OUT_TAGS = frozenset("nav footer aside form head button dialog menu".split())
_LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar side aside footer foot header masthead topbar cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login form search share sharing social related "
    "recommended recommendations more-links comment comments respond replies disqus discussion widget toolbar pagination pager "
    "copyright legal disclaimer skip".split())
# names that are left out inside the article too, where a part of a name says little: "related-work" may be a heading of the text
_LEFT_OUT_NAMES = frozenset(
    "ad-slot ad-container ad-unit ad-banner ad-block ad-box social-share social-links share-buttons share-bar share-links related-posts "
    "related-articles related-links related-stories newsletter-signup newsletter-form cookie-banner cookie-notice comment-list comments-area "
    "comment-form login-form search-form nav-links skip-link skip-to-content promo-box sponsored-content back-to-top".split())


def _left_out(tag: str, attributes: str, inside: bool) -> bool:
    if tag in _LEFT_OUT_TAGS or tag == "header" and not inside:
        return True
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            for word in value.split():
                word = word.replace("_", "-")
                if (word in _LEFT_OUT_WORDS or word in _LEFT_OUT_NAMES
                        or not inside and not _LEFT_OUT_WORDS.isdisjoint(re.split(r"[-\d]+", word))):
                    # words such as "header" name parts of the text where they stand in the article
                    if tag not in ("body", "main", "article", "html") and not (inside and tag in _CLOSED_BY_BLOCK):
                        return True
        elif name == "role" and value in _LEFT_OUT_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
    return False


def _step(tag: str, attributes: str) -> str:
    """Tag and classes as one step of a generalised path."""
    for name, value in _ATTRIBUTE.findall(attributes) if "class" in attributes.lower() else ():
        if name.lower() == "class":
            words = sorted({_DIGITS.sub("N", w) for w in value.strip("\"'").lower().split()})
            if words:
                return f"{tag}.{'.'.join(words)}"
    return tag


def blocks(page: str):
    """(containers, found): found has (container, text, size outside links, size in links) of each block of running
    text, in page order.

    `container` numbers the innermost container, `containers` has (path, outer container) of each.
    """
    containers = [("", -1)]
    stack = [("", 0, False)]  # tag, container, left out
    texts, linked, plain, link = [], 0, 0, 0
    silent, depth = None, 0  # an inline element that is left out, and how deep its own tag is open
    out = []

    def flush():
        nonlocal linked, plain
        if texts:
            text = " ".join(html.unescape("".join(texts)).split())
            if text and not stack[-1][2]:
                out.append((stack[-1][1], text, plain, linked))
            texts.clear()
        linked = plain = 0

    at, inside = 0, 0
    for token in _TOKEN.finditer(page):
        if token.start() > at and not stack[-1][2] and not silent:
            text = page[at:token.start()]
            texts.append(text)
            if link:
                linked += len(text.strip())
            else:
                plain += len(text.strip())
        at = token.end()
        tag = token[4]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _INLINE:
            if silent:
                depth += 0 if tag != silent or tag in _VOID else -1 if token[3] else 1
                silent = silent if depth else None
                continue
            if not token[3] and tag not in _VOID and token[5] and _left_out(tag, token[5], inside > 0):
                silent, depth = tag, 1
                continue
            if tag == "br":
                texts.append(" ")
            elif tag == "a":
                link = 0 if token[3] else 1
            continue
        flush()
        link, silent = 0, None
        if token[3]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    inside -= sum(x[0] in ("article", "main") for x in stack[i:])
                    del stack[i:]
                    break
                if stack[i][0] in ("td", "th", "table") and tag not in ("tr", "tbody", "table", "thead", "body", "html", "article", "main"):
                    break
            continue
        if tag in _VOID or token[5].endswith("/") and tag not in _CONTAINERS and tag not in _CLOSED_BY_BLOCK:
            continue
        if stack[-1][0] in _CLOSED_BY_BLOCK:
            stack.pop()
        for closed in (_SAME.get(tag, ()),):
            while stack[-1][0] in closed:
                stack.pop()
        _, container, left_out = stack[-1]
        left_out = left_out or _left_out(tag, token[5], inside > 0)
        if tag in _CONTAINERS and not left_out:
            containers.append((f"{containers[container][0]}>{_step(tag, token[5])}", container))
            container = len(containers) - 1
        inside += tag in ("article", "main")
        stack.append((tag, container, left_out))
    if at < len(page) and not stack[-1][2] and not silent:
        rest = page[at:]
        texts.append(_UNFINISHED.sub("", rest))
        plain += len(rest.strip())
    flush()
    return containers, out


def _only_links(plain: int, linked: int) -> bool:
    return plain <= PLAIN_SHARE * (plain + linked)


def best_container(containers, found) -> int:
    """The deepest container with most of the text outside links, where what it leaves out is mostly links."""
    total, links = [0] * len(containers), [0] * len(containers)
    for container, _, plain, linked in found:
        while container >= 0:
            total[container] += plain
            links[container] += linked
            container = containers[container][1]
    best = 0
    for i in range(1, len(containers)):
        path, outer = containers[i]
        if outer == best and total[i] >= SHARE * max(total[0], 1) and _only_links(total[best] - total[i], links[best] - links[i]):
            best = i
            if path.rpartition(">")[2].partition(".")[0] in ("article", "main"):
                break
    return best


def _inside(containers, chosen) -> list[bool]:
    inside = [False] * len(containers)
    for i, (_, outer) in enumerate(containers):
        inside[i] = i in chosen or outer >= 0 and inside[outer]
    return inside


def main_text(page: str, winner: str | None) -> tuple[str, str]:
    """(text, path used) of a page, by the path `winner` where the page has it and no running text lies beside it."""
    containers, found = blocks(page)
    chosen = {best_container(containers, found)}
    inside = _inside(containers, chosen)
    by_host = {i for i, (path, _) in enumerate(containers) if path == winner} if winner else set()
    if by_host and by_host != chosen:
        held = _inside(containers, by_host)
        lost = [(plain, linked) for container, _, plain, linked in found if inside[container] and not held[container]]
        if _only_links(sum(x for x, _ in lost), sum(x for _, x in lost)):
            chosen, inside = by_host, held
    text = "\n".join(text for container, text, *_ in found if inside[container])
    return text, containers[min(chosen)][0]


def container_votes(pages: DataFrame) -> DataFrame:
    """host, path, votes; `pages` has host and html."""

    def run(batches):
        for batch in batches:
            seen: dict[tuple[str, str], int] = {}
            for piece in parts(batch, "html"):
                for host, page in zip(piece.column("host").to_pylist(), strings(piece.column("html")).to_pylist()):
                    containers, found = blocks(page)
                    if found:
                        vote = host, containers[best_container(containers, found)][0]
                        seen[vote] = seen.get(vote, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in seen], pa.string()), pa.array([p for _, p in seen], pa.string()),
                                              pa.array(list(seen.values()), pa.int64())], names=["host", "path", "votes"])

    votes = pages.select("host", "html").mapInArrow(run, "host STRING, path STRING, votes BIGINT")
    return votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))


def extract_pages(pages: DataFrame, id_column="page_id", url_column="url", html_column="html",
                  broadcast_hosts=BROADCAST_HOSTS) -> DataFrame:
    """page_id, url, text, n_chars, path of every page."""
    pages = picked(pages, page_id=id_column, url=url_column, html=html_column).withColumn("host", host_of(F.col("url")))
    # one row for each host and path that any page voted for: most votes, then the smaller path
    order = Window.partitionBy("host").orderBy(F.desc("votes"), "path")
    winners = checkpointed(container_votes(pages).withColumn("_place", F.row_number().over(order)).filter("_place = 1")
                           .select("host", F.col("path").alias("winner")))
    if winners.count() <= broadcast_hosts:
        joined = pages.join(F.broadcast(winners), "host", "left")
    else:
        salted = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = pages.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(
            salted, ["host", "salt"], "left")

    def run(batches):
        for batch in batches:
            for piece in parts(batch, "html"):
                pairs = [main_text(page, winner) for page, winner in
                         zip(strings(piece.column("html")).to_pylist(), piece.column("winner").to_pylist())]
                texts = [t for t, _ in pairs]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64()), pa.array([p for _, p in pairs], pa.string())],
                    names=["page_id", "url", "text", "n_chars", "path"])

    return joined.select("page_id", "url", "html", "winner").mapInArrow(
        run, "page_id BIGINT, url STRING, text STRING, n_chars BIGINT, path STRING")
