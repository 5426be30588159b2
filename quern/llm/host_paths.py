"""Main text of web pages by the consensus of a host's pages on where it lies.

Every page is parsed into blocks of text and the containers around them. Containers are scored by the text
they hold that is no link and no boilerplate; each page votes, with these scores, for the generalised path of
its containers (tags and classes from the root, digits replaced), and Spark sums the votes per host and path.
Each page is then read again and its text taken from the containers on its host's winning path; a page that
has none takes its own best container. A container that holds most of what is around it, below the body, gives way to
what is around it: a title and a lead beside the body of an article, or its other parts.

Boilerplate is left out at any depth: navigation, page headers, footers, asides, forms, scripts, styles, hidden
elements, and elements whose class, id or role names a menu, sidebar, notice, advert or reader comment. A name after
"has", "no", "with" or "without" says nothing. On a page without an ``article`` or ``main`` part, an element that is only
named like a sidebar, widget or similar and holds most of the text outside links is none. A container inside an ``article`` stands for it.

How it runs. Two reads of the pages in Python tasks; between them only (host, path, score) rows move, summed
before the shuffle, so that a host with a third of all pages is no hot group. The table of winners has one row
per host and is written first: the optimizer broadcasts it if it is small, and can split a hot host if not.

Defined results:
- A null or empty page has no text. A page without any block in a container takes what the body holds.
- Votes that tie go to the path that sorts first, on a page to the container that comes first.
- A null URL is a host of its own, the empty one. Repeated rows are pages of their own.
- An empty table gives an empty result. Other columns are never read, whatever their names.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_columns, whole, written


# Names of elements, by what they mean for the text.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
DROPPED = RAW | {"nav", "footer", "aside", "form", "head", "svg", "object", "select", "button", "dialog", "menu"}
CONTAINERS = {"html", "body", "main", "article", "section", "div", "td", "blockquote", "details", "center"}
BREAKS = CONTAINERS | DROPPED | {
    "address", "caption", "dd", "dl", "dt", "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "legend", "li", "ol", "p", "pre", "summary", "table", "tbody", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Words that begin a part of a class, id or role of boilerplate.
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?<!\bhas[_-])(?<!\bno[_-])(?<!\bwith[_-])(?<!\bwithout[_-])(?:ads?|adv|advert\w*|adsense|adbox|banner\w*|breadcrumbs?|comments?|comment-?\w*|commentlist|complementary"
    r"|consent|contentinfo|cookies?|cookie\w*|discussion|disqus\w*|gdpr|menu\w*|modal|nav|navbar|navigation|newsletter"
    r"|notice\w*|notification\w*|outbrain|overlay|pagination|pager|popup|promo\w*|recommend\w*|related\w*|replies|reply"
    r"|respond|search|share|sharing|shares|sidebar\w*|signup|skip|social\w*|sponsor\w*|subscribe|subscription|taboola"
    r"|teasers?|toolbar|trackbacks?|widget\w*|alert)(?=$|[\s_-])"
)
# Of those, what is never the article, however much of it there is.
NEVER = re.compile(
    r"(?:^|[\s_-])(?<!\bhas[_-])(?<!\bno[_-])(?<!\bwith[_-])(?<!\bwithout[_-])(?:comments?|comment-?\w*|commentlist|discussion"
    r"|disqus\w*|replies|reply|respond|trackbacks?|ads?|adv|advert\w*|adsense|adbox|sponsor\w*|promo\w*|outbrain|taboola|nav"
    r"|navbar|navigation|menu\w*|breadcrumbs?|pagination|pager|cookies?|cookie\w*|consent|gdpr|notice\w*|newsletter|popup)(?=$|[\s_-])"
)
# These only where nothing beside them says that the element belongs to the article.
OUTER = re.compile(r"(?:^|[\s_-])(?:header|footer|masthead|copyright|legal)(?=$|[\s_-])")
INNER = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|content|body|main)(?=$|[\s_-])")

_TAG = re.compile(
    r"<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>|[!?][^>]*>)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TELLING = re.compile(r"\b(?:class|id|role|hidden|style|aria-hidden)\b", re.IGNORECASE)
LONGEST_PATH = 400


@dataclass
class Page:
    """Containers (parent, path, index of the article around it or of itself) and blocks (text, container, link characters)."""

    containers: list[tuple[int, str, int]]
    blocks: list[tuple[str, int, int]]


NO, NAMED, YES = 0, 1, 2  # boilerplate: not, by its name only, for sure


def _boilerplate(tag: str, attributes: dict[str, str], in_article: bool) -> int:
    if tag in DROPPED or (tag == "header" and not in_article):
        return YES
    if not attributes:
        return NO
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return YES
    if "none" in attributes.get("style", "") and re.search(r"display\s*:\s*none", attributes["style"]):
        return YES
    if tag in ("html", "body", "article", "main"):
        return YES if tag == "article" and re.search(r"comment", attributes.get("class", "")) else NO
    found = NO
    for name in ("class", "id", "role"):
        value = attributes.get(name)
        if value and (BOILERPLATE.search(value) or (OUTER.search(value) and not INNER.search(value))):
            if NEVER.search(value):
                return YES
            found = NAMED
    return found


def parse(page: str) -> Page:
    """The page's containers and blocks; elements that hold most of its text are kept whatever they are named."""
    out, named, around = _parse(page, frozenset())
    if not named:
        return out
    if any(out.containers[c][2] >= 0 or ">main" in out.containers[c][1] for _, c, _ in out.blocks):
        return out  # the page says itself where its text is
    total = sum(named.values()) + sum(max(0, len(b) - links) for b, _, links in out.blocks)
    for place in sorted(around, reverse=True):  # inner elements begin later
        named[around[place]] += named[place]
    spared = frozenset(place for place, amount in named.items() if 2 * amount > total)
    return _parse(page, spared)[0] if spared else out


def _parse(page: str, spared: frozenset[int]) -> tuple[Page, dict[int, int], dict[int, int]]:
    """What ``parse`` gives with these elements kept, and of the others that are boilerplate by name only, by place:
    characters outside links that lie in no such element inside, and the place of the one around."""
    out = Page([(-1, "", -1)], [])
    named: dict[int, int] = {}
    around: dict[int, int] = {}
    # Open elements: tag, container, whether text is dropped, and the place of the named element that drops it, or -1.
    # The first stands for the page and is never closed.
    stack: list[tuple[str, int, bool, int]] = [("", 0, False, -1)]
    text: list[str] = []
    links = depth = 0  # link characters of the block, open links

    def end_block() -> None:
        nonlocal links
        if text:
            block = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if block:
                out.blocks.append((block, stack[-1][1], links))
        links = 0

    at = 0
    while True:
        match = _TAG.search(page, at)
        piece = page[at : match.start()] if match else page[at:]
        if piece and not stack[-1][2]:
            text.append(piece)
            if depth:
                links += len(piece)
        elif piece and stack[-1][3] >= 0 and not depth:
            named[stack[-1][3]] += len(piece.strip())
        if not match:
            break
        at = match.end()
        tag = match["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        closing = bool(match["close"])
        if tag in BREAKS:
            end_block()
            if stack[-1][0] == "p" and not closing:
                stack.pop()
        elif tag == "br":
            text.append(" ")
            continue
        elif tag == "a":
            depth = max(0, depth + (-1 if closing else 1))
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        rest = match["rest"]
        if tag in RAW and not rest.endswith("/"):
            end = re.compile(rf"</{tag}", re.IGNORECASE).search(page, at)
            at = end.start() if end else len(page)
            continue
        if tag in VOID:
            continue
        attributes = {}
        if rest and _TELLING.search(rest):
            for name, *values in _ATTRIBUTE.findall(rest):
                attributes.setdefault(name.lower(), next(filter(None, values), "").lower())
        _, container, dropped, by_name = stack[-1]
        article = out.containers[container][2]
        drop = dropped
        if not dropped or by_name >= 0:
            kind = _boilerplate(tag, attributes, article >= 0)
            if kind == YES:
                drop, by_name = True, -1
            elif kind == NAMED and match.start() not in spared:
                if by_name >= 0:
                    around[match.start()] = by_name
                drop, by_name = True, match.start()
                named[by_name] = 0
        if tag in CONTAINERS or (drop, by_name) != (dropped, stack[-1][3]) or tag in ("header", "table", "ul", "ol", "dl") or tag in DROPPED:
            if tag == "li" and stack[-1][0] == "li":
                stack.pop()
            if tag in CONTAINERS and not drop:
                classes = ".".join(re.sub(r"\d+", "#", attributes.get("class", "")).split())
                path = f"{out.containers[container][1]}>{tag}" + (f".{classes}" if classes else "")
                if len(path) > LONGEST_PATH:
                    path = f"{hashlib.md5(path.encode()).hexdigest()}>{tag}"
                container = len(out.containers)
                inside = article if article >= 0 else container if tag == "article" else -1
                out.containers.append((stack[-1][1], path, inside))
            stack.append((tag, container, drop, by_name))
    end_block()
    return out, named, around


def scores(page: Page) -> dict[int, int]:
    """Of containers: the text that is no link, halved with every container in between; articles stand for their parts."""
    own = [0] * len(page.containers)
    for block, container, links in page.blocks:
        own[container] += max(0, len(block) - 2 * links)
    total: dict[int, int] = {}
    for container, amount in enumerate(own):
        at = container
        while amount > 0 and at >= 0:
            parent, _, article = page.containers[at]
            chosen = article if article >= 0 else at
            total[chosen] = total.get(chosen, 0) + amount
            at = page.containers[chosen][0] if article >= 0 else parent
            amount //= 2
    return total


def _own_text(page: Page) -> list[int]:
    """Per container: characters outside links of the blocks that lie directly in it."""
    own = [0] * len(page.containers)
    for block, container, links in page.blocks:
        own[container] += max(0, len(block) - links)
    return own


def _around(page: Page, chosen: set[int]) -> set[int]:
    """Containers of whose text the chosen ones hold most, in place of those.

    Only from inside the body, not out of an article or main part, and only where what comes with it is text that lies
    beside the container or in other containers of some length, and not in links.
    """
    own = _own_text(page)
    below, links = own[:], [0] * len(own)
    children: list[list[int]] = [[] for _ in own]
    for _, container, linked in page.blocks:
        links[container] += linked
    for i in range(len(own) - 1, 0, -1):  # parents come first
        parent = page.containers[i][0]
        below[parent] += below[i]
        links[parent] += links[i]
        children[parent].append(i)

    @cache
    def gives_way(parent: int, at: int) -> bool:
        """Whether the parent stands in for ``at`` (-1: for those chosen of its children)."""
        mine = [i for i in children[parent] if i == at or i in chosen]
        others = [below[i] for i in children[parent] if i != at and i not in chosen]
        held = sum(below[i] for i in mine)
        more, linked = below[parent] - held, links[parent] - sum(links[i] for i in mine)
        long = sum(n for n in others if 10 * n >= held)
        return more <= held and 5 * (own[parent] + long) >= 4 * more and 3 * linked <= more

    out = set()
    for at in chosen:
        while True:
            parent, path, _ = page.containers[at]
            if parent <= 0 or _tag_of(path) in ("article", "main") or _tag_of(page.containers[parent][1]) in ("body", "html", ""):
                break
            if not gives_way(parent, -1 if at in chosen else at):
                break
            at = parent
        out.add(at)
    return out


def _tag_of(path: str) -> str:
    return path.rpartition(">")[2].partition(".")[0]


def extract(page: Page, path: str | None) -> str:
    """The blocks inside the containers on this path, or inside the page's best container where it has none."""
    chosen = {i for i, (_, own, _) in enumerate(page.containers) if i and own == path}
    if not chosen:
        found = scores(page)
        if not found:
            return ""
        chosen = {min(found, key=lambda i: (-found[i], i))}
    chosen = _around(page, chosen)
    inside = [False] * len(page.containers)
    for i, (parent, _, _) in enumerate(page.containers):  # parents come first
        inside[i] = i in chosen or (parent >= 0 and inside[parent])
    return "\n".join(block for block, container, _ in page.blocks if inside[container])


def _host(url: str) -> Column:
    return F.lower(F.regexp_extract(whole(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _vote(batches: Iterator[list]) -> Iterator[list]:
    for hosts, pages in batches:
        rows = []
        for host, page in zip(hosts.to_pylist(), pages, strict=True):
            parsed, votes = parse(page.as_py()), {}
            for container, score in scores(parsed).items():
                path = parsed.containers[container][1]
                votes[path] = votes.get(path, 0) + score
            rows += [(host, path, score) for path, score in votes.items()]
        if rows:
            yield list(zip(*rows, strict=True))


def _extract(batches: Iterator[list]) -> Iterator[list]:
    for ids, urls, pages, paths in batches:
        texts = [
            extract(parse(page.as_py()), path) for page, path in zip(pages, paths.to_pylist(), strict=True)
        ]
        yield [ids, urls, texts, [len(t) for t in texts]]


def winning_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, path: the path with the highest sum of scores over the host's pages."""
    rows = pages.select(_host(url).alias("host"), whole(html).alias("html"))
    votes = map_columns(rows, _vote, "host string, path string, score bigint")
    summed = votes.groupBy("host", "path").agg(F.sum("score").alias("score"))
    best = F.min(F.struct(-F.col("score"), F.col("path")))
    return summed.groupBy("host").agg(best.alias("best")).select("host", F.col("best.path").alias("path"))


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, url, text, n_chars per row."""
    winners = written(winning_paths(pages, url, html).withColumnRenamed("host", "of"), "host-paths")
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), whole(html).alias("html"), _host(url).alias("host"))
    told = rows.join(winners, F.col("host") == F.col("of"), "left").select("id", "url", "html", "path")
    kind = pages.schema[key].dataType.simpleString()
    return map_columns(told, _extract, f"`{key}` {kind}, url string, text string, n_chars bigint")
