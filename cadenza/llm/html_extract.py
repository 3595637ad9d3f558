"""HTML extraction by tree scoring.

Paragraph blocks give points for length and commas to their ancestors; an element's points
are discounted by its link density; the best container and its fitting siblings are kept,
without subtrees that are page furniture.
"""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from .common import map_rows

# HTML element names and the words that mark page furniture in class and id.
RAW = frozenset("script style template noscript iframe object svg canvas math textarea select option title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset("nav aside footer menu dialog head button fieldset search".split())
CLOSES_P = BLOCK - {"html", "body"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre blockquote td li dd".split())
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|menus|sidebar|side-bar|aside|footer|foot|"
    r"comment|comments|commentlist|disqus|respond|reply|replies|cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|"
    r"subscribe|signup|login|share|sharing|social|related|recommend\w*|breadcrumb|breadcrumbs|pagination|pager|toolbar|widget|masthead|topbar|"
    r"disclaimer|skip|search|sitemap|copyright|header|site-header|page-header)(?:$|[\s_\d-])", re.I)  # fmt: skip
CONTENT = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text|page)(?:$|[\s_-])", re.I)
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=\s|/|$)""", re.I)

#: A layout's property, not the element's kind: has-sidebar, with-nav.
LAYOUT = re.compile(r"(?:^|(?<=[\s_-]))(?:has|with|no|without)[_-][^\s_-]+", re.I)
#: What makes even an article or main element furniture.
NO_ARTICLE = re.compile(r"(?:^|[\s_-])(?:comment\w*|repl(?:y|ies)|promo\w*|ads?|advert\w*)(?:$|[\s_\d-])", re.I)
#: Ancestors that a paragraph's points reach; the next ones would get under a seventieth of them.
REACH = 24
CONTENT_NAMES = frozenset("article content entry main post story".split())


def _furniture(tag: str, value: str, inside: bool) -> bool:
    """Whether a class or id names page furniture; a content word of its own and the header of an article win."""
    value = LAYOUT.sub("", value)
    if tag in ("article", "main") and not NO_ARTICLE.search(value):
        return False
    if inside and (tag == "header" or tag in HEADINGS):
        value = re.sub(r"(?:^|(?<=[\s_-]))(?:header|masthead)(?=$|[\s_-])", "", value, flags=re.I)
    return bool(FURNITURE.search(value)) and CONTENT_NAMES.isdisjoint(value.lower().split())


class Node:
    __slots__ = ("block", "bonus", "chars", "dropped", "link_chars", "links", "linky", "parent", "points", "side", "tag", "wanted")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, bonus: float):
        self.tag, self.parent, self.dropped, self.bonus = tag, parent, dropped, bonus
        self.block = self if tag in BLOCK or parent is None else parent.block
        self.points, self.chars, self.link_chars, self.links = 0.0, 0, 0, 0
        self.side, self.wanted, self.linky = None, False, False

    def density(self) -> float:
        return self.link_chars / self.chars if self.chars else 0.0

    def score(self) -> float:
        return (self.points + self.bonus) * (1 - self.density())


def _attributes(tag: str, text: str, inside: bool, names: bool = True) -> tuple[bool, float]:
    """Whether an element is furniture, and the bonus its names give."""
    dropped, bonus = tag in DROPPED or (tag == "header" and not inside), 0.0
    if text and "=" in text or "hidden" in text:
        for name, value in ATTRIBUTE.findall(text):
            name, value = name.lower(), value.strip("\"' ")
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
                dropped = True
            elif name == "role":
                dropped |= value in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu")
                bonus += 25.0 * (value in ("main", "article"))
            elif name in ("class", "id") and tag not in ("html", "body"):
                if names and _furniture(tag, value, inside):
                    dropped = dropped or tag in BLOCK or tag == "span"
                elif CONTENT.search(value):
                    bonus += 10.0
    return dropped, bonus + (25.0 if tag in ("article", "main") else 5.0 if tag in ("div", "section") else 0.0)


def parse(page: str, names: bool = True) -> tuple[list[tuple[str, int, Node]], list[Node]]:
    """Blocks in page order (text, characters of it in links, the block's element), and all elements
    in the order of their start tags. Without ``names``, class and id don't make an element
    furniture. A page that nests deeply costs no more than its length."""
    root = Node("#", None, False, 0.0)
    stack, blocks, nodes = [root], [], [root]
    buffer: list[str] = []
    opened: Counter = Counter()
    linked = 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                blocks.append((text, min(linked, len(text)), stack[-1].block))
        linked = 0

    def pop_to(i: int) -> None:
        for node in stack[i:]:
            opened[node.tag] -= 1
        del stack[i:]

    def close(wanted: frozenset | set, stop: frozenset | set) -> None:
        if not any(opened[t] for t in wanted):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in wanted:
                pop_to(i)
                return
            if stack[i].tag in stop:
                return

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.match(page, at)
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            text = m[0]
            if text[0] != "<" or text == "<":
                if not stack[-1].dropped:
                    buffer.append(text)
                    if opened["a"]:
                        linked += len(text.strip())
            continue
        if m[1] or m[4]:
            if tag in BLOCK:
                flush()
            if tag == "br" or tag == "p" and not opened["p"]:
                continue
            close({tag}, frozenset() if tag in BLOCK else BLOCK)
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            if not (m[3] or m[6] or "").rstrip().endswith("/") or tag in ("script", "style", "title"):
                at = stop.end() if stop else end
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P:
                close({"p"}, BLOCK - {"p"})
            if tag in HEADINGS:
                close(HEADINGS, BLOCK - HEADINGS)
            elif tag == "li":
                close({"li"}, {"ul", "ol", "menu"})
            elif tag in ("dt", "dd"):
                close({"dt", "dd"}, {"dl"})
            elif tag in ("td", "th"):
                close({"td", "th"}, {"table", "tr"})
            elif tag == "tr":
                close({"tr"}, {"table"})
            elif tag == "body":
                close({"head"}, set())
        if tag in VOID:
            continue
        up = stack[-1]
        dropped, bonus = _attributes(tag, m[3] or m[6] or "", opened["article"] + opened["main"] > 0, names)
        stack.append(Node(tag, up, up.dropped or dropped, bonus))
        nodes.append(stack[-1])
        opened[tag] += 1
        up.links += tag == "a"
    flush()
    for text, linked, node in blocks:
        node.chars += len(text)
        node.link_chars += linked
    for node in reversed(nodes[1:]):  # what an element holds, from the innermost ones on
        up = node.parent
        up.chars, up.link_chars, up.links = up.chars + node.chars, up.link_chars + node.link_chars, up.links + node.links
    # a form is furniture, unless it is laid around most of the page
    for node in nodes[1:]:
        node.dropped = node.parent.dropped or node.tag == "form" and 2 * node.chars < nodes[0].chars
    return [x for x in blocks if not x[2].dropped], nodes


def main_text(page: str | None) -> str:
    """The article's blocks, joined by two line feeds; empty for null or a page without any."""
    blocks, nodes = parse(page) if page else ([], [])
    if page and not blocks:
        blocks, nodes = parse(page, names=False)
    if not blocks:
        return ""
    candidates: dict[int, Node] = {}
    for text, linked, node in blocks:
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text))
        up = node.parent if node.tag in PARAGRAPHS | HEADINGS and node.parent is not None else node
        level = 0
        while up is not None and level < REACH:
            up.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            candidates[id(up)] = up
            up, level = up.parent, level + 1
    best = max(candidates.values(), key=Node.score)
    up = best.parent
    while up is not None:  # sections of one article belong together
        if up.tag in ("article", "main"):
            best = up
        up = up.parent
    bar, kept = max(10.0, 0.2 * best.score()), {id(best)}
    if best.parent is not None:
        for node in nodes[1:]:
            node.side = node if node.parent is best.parent else node.parent.side
        seen: set[int] = set()
        for text, _, node in blocks:
            side = node.side
            if side is None or id(side) in seen:
                continue
            seen.add(id(side))
            prose = side.tag in PARAGRAPHS and side.density() < 0.25 and (side.chars > 80 or text[-1:] in ".!?")
            if prose or side.tag in HEADINGS or (side.tag in ("div", "section", "article") and side.score() >= bar and side.density() < 0.25):
                kept.add(id(side))
    for node in nodes:  # inside what is kept, lists of links go
        up = node.parent
        if id(node) in kept:
            node.wanted = True
        elif up is not None:
            node.wanted = up.wanted
            node.linky = up.linky or node.tag in ("ul", "ol", "div", "table") and node.links > 1 and node.density() > 0.8
    return "\n\n".join(text for text, _, node in blocks if node.wanted and not node.linky)


def extract_main_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per page: the columns of keep, text string and n_chars long (code points).

    Null, empty or text-free html gives an empty text. Truncated pages give what they hold.
    Repeated rows stay repeated; other columns of pages are not read.
    """
    kinds = dict(pages.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", text string, n_chars long"

    def run(cols: dict) -> dict:
        texts = [main_text(x) for x in cols["__html"].to_pylist()]
        return {c: cols[c] for c in keep} | {"text": texts, "n_chars": [len(t) for t in texts]}

    from pyspark.sql import functions as F

    return map_rows(pages.select(*keep, F.col(html_col).alias("__html")), schema, run)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages; null and empty html give an empty text."""
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
