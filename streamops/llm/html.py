"""Main text of web pages by tree scoring.

A tolerant tag reader builds the element tree; elements that are never article
text (menus, page headers and footers, sidebars, adverts, notices, forms,
scripts, reader comments) are marked by tag, role, class and id.  A mark by a form
or aside tag or by a word of a class or id is doubtful: it does not count on a
form, or an element that is named like content or holds an article or main
element, if most of the page's unlinked text is in it.  Every block
of text gives points for length and commas to the element that holds it and, in
falling shares, to that element's ancestors; an element's score is discounted
by its link density.  The best element (or the article around it) is kept with
those of its siblings that score well too, and its blocks are the text.  Beside an
article these are articles with three tenths of its points, and paragraphs of 25
characters or more right in the main element.

Each page is read on its own, in one pass without recursion, so the work is
linear in the page and any nesting depth is safe.

Defined results: a null or empty page, and one without text, gives ''; repeated
rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamops.llm.common import as_text

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option "
                  "p pre section select summary table tbody tfoot thead tr caption ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open element of one of these kinds, up to a boundary.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
P_KEEPS = frozenset("address article aside blockquote button body caption center dd details dialog div dl dt fieldset "
                    "figure footer form header html li main nav ol section table td th ul".split())
DOUBTFUL = frozenset("aside form".split())
NEVER = frozenset("nav footer button select menu dialog object embed svg canvas audio video iframe "
                  "datalist fieldset label input math".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form "
                  "toolbar tablist status".split())
#: Words of class and id attributes that mark what is not the article.
UNLIKELY = re.compile(
    r"(?:^|[^a-z])(?:ads?|adv|advert\w*|adbox|banner|promo\w*|sponsor\w*|nav|navbar|navigation|menu\w*|breadcrumbs?|"
    r"masthead|foot|footer|sidebar|side|aside|rail|cookies?|consent|gdpr|notices?|notification\w*|popup|modal|overlay|"
    r"newsletter|subscri\w*|signup|signin|login|search\w*|social\w*|shar(?:e|ing)\w*|related|recommend\w*|trending|"
    r"pagination|pager|paging|toolbar|widget\w*|skip|alert\w*|legal|copyright|disclaimer|outbrain|taboola|hidden)"
    r"(?:[^a-z]|$)")
COMMENTS = re.compile(r"(?:^|[^a-z])(?:comments?\w*|disqus\w*|respond|repl(?:y|ies)|discussion|guestbook)(?:[^a-z]|$)")
HEADER = re.compile(r"(?:^|[^a-z])(?:header|topbar|site-?title)(?:[^a-z]|$)")
LIKELY = re.compile(r"(?:^|[^a-z])(?:article\w*|body|content\w*|entry|main|page|post|text|blog|story)(?:[^a-z]|$)")
BASE = {"article": 15.0, "main": 10.0, "div": 5.0, "section": 5.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0,
        "ol": -3.0, "ul": -3.0, "dl": -3.0, "li": -3.0, "th": -5.0, "table": -3.0}

TAG = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                 r"|<[!?/][^>]*+(?:>|\Z)", re.S)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Page:
    """The element tree as flat lists; element 0 is the root."""

    def __init__(self):
        self.tag, self.parent, self.weight = ["#root"], [-1], [0.0]
        self.mark: list[str | None] = [None]                # never article text: "sure" or "doubtful"
        self.runs: list[tuple[int, int, str, bool]] = []    # (block, element, text, inside a link)

    def add(self, tag: str, parent: int, attrs: str) -> int:
        kind = {}
        if attrs.strip(" \t\r\n/"):
            kind = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "").lower() for m in ATTR.finditer(attrs)}
        name = f"{kind.get('class', '')} {kind.get('id', '')}"
        root = tag in ("html", "body")
        mark = None
        if not root:
            if (tag in NEVER or kind.get("role") in ROLES or "hidden" in kind or kind.get("aria-hidden") == "true"
                    or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", kind.get("style", "")) is not None
                    or COMMENTS.search(name) is not None):
                mark = "sure"
            elif tag not in HEADINGS and (tag == "header" or HEADER.search(name)) and not self.inside(parent, "article"):
                mark = "sure"                          # a page's header; an article's own header holds its title
            elif tag in DOUBTFUL or (tag not in ("article", "main") and UNLIKELY.search(name) is not None):
                mark = "doubtful"
        self.tag.append(tag)
        self.parent.append(parent)
        self.mark.append(mark)
        self.weight.append(25.0 if not root and LIKELY.search(name) else 0.0)
        return len(self.tag) - 1

    def inside(self, node: int, tag: str) -> bool:
        while node > 0:
            if self.tag[node] == tag:
                return True
            node = self.parent[node]
        return False

    def off(self) -> list[bool]:
        """Which elements are left out: marked ones and what is in them."""
        n = len(self.tag)
        sure, plain = [False] * n, [0] * n
        holds = [t in ("article", "main") for t in self.tag]
        for i in range(1, n):                              # parents come before children
            sure[i] = self.mark[i] == "sure" or sure[self.parent[i]]
        for _, node, raw, linked in self.runs:
            plain[node] += 0 if linked or sure[node] else len(raw.strip())
        for i in range(n - 1, 0, -1):
            plain[self.parent[i]] += plain[i]
            holds[self.parent[i]] |= holds[i] and not sure[i]
        out = [False] * n
        for i in range(1, n):
            wraps = (self.tag[i] == "form" or self.weight[i] > 0 or holds[i]) and 2 * plain[i] > plain[0]
            out[i] = out[self.parent[i]] or sure[i] or (self.mark[i] == "doubtful" and not wraps)
        return out


def parse(html: str) -> Page:
    page, stack, block, links, at = Page(), [0], 0, 0, 0

    def text(a: int, b: int) -> None:
        if b > a:
            page.runs.append((block, stack[-1], html[a:b], links > 0))

    def close(keep: int) -> None:
        nonlocal links
        while len(stack) > keep:
            links -= page.tag[stack.pop()] == "a"

    def open_at(kinds, stops) -> int:
        for i in range(len(stack) - 1, 0, -1):
            t = page.tag[stack[i]]
            if t in kinds:
                return i
            if t in stops:
                return 0
        return 0

    size = len(html)
    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            break
        m = TAG.match(html, lt) or LOOSE.match(html, lt)
        if m is None:                                  # a bare < is text
            text(at, lt + 1)
            at = lt + 1
            continue
        text(at, lt)
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "br":
                page.runs.append((block, stack[-1], " ", False))
                continue
            stops = frozenset() if tag in BLOCK or tag in ("td", "th", "a") else BLOCK
            if i := open_at({tag}, stops):
                close(i)
                block += tag in BLOCK
            if tag in ("td", "th"):
                page.runs.append((block, stack[-1], " ", False))
            continue
        if tag in ENDS and (i := open_at(*ENDS[tag])):
            close(i)
        if tag in BLOCK:
            block += 1
            if i := open_at({"p"}, P_KEEPS):
                close(i)
            if tag in HEADINGS and page.tag[stack[-1]] in HEADINGS:
                close(len(stack) - 1)
        if tag in VOID:
            if tag in ("br", "hr", "img", "wbr"):
                page.runs.append((block, stack[-1], "" if tag == "wbr" else " ", False))
            continue
        if tag in ("td", "th"):
            page.runs.append((block, stack[-1], " ", False))
        if tag == "a" and (i := open_at({"a"}, P_KEEPS)):
            close(i)
        if tag in RAW:                                 # its content is no markup and no article text
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            gt = html.find(">", end.start()) if end else -1
            at = gt + 1 if gt >= 0 else size
            continue
        if not m[3].endswith("/") or tag not in ("svg", "path", "use"):
            stack.append(page.add(tag, stack[-1], m[3]))
            links += tag == "a"
    text(at, size)
    return page


def main_text(html: str | None) -> str:
    """The article's blocks, joined by blank lines."""
    if not html:
        return ""
    page = parse(html)
    n, off = len(page.tag), page.off()
    # blocks of text that may count
    blocks: dict[int, list] = {}
    for block, node, raw, linked in page.runs:
        if not off[node]:
            b = blocks.setdefault(block, [node, [], 0, 0])
            b[1].append(unescape(raw) if "&" in raw else raw)
            size = len(raw.strip())
            b[2] += size
            b[3] += size * linked
    found: list[tuple[int, str]] = []                  # (element, text)
    score, size, link = [0.0] * n, [0] * n, [0] * n
    for _, (node, parts, length, linked) in sorted(blocks.items()):
        words = " ".join("".join(parts).split())
        if not words:
            continue
        while page.tag[node] not in BLOCK and page.tag[node] not in ("td", "th") and page.parent[node] > 0:
            node = page.parent[node]
        found.append((node, words))
        size[node] += length
        link[node] += linked
        points = (len(words) >= 25) + words.count(",") + words.count("，") + min(len(words) / 100, 3.0)
        up, level = (page.parent[node] if page.tag[node] not in ("article", "main", "div", "section", "body")
                     else node), 0
        while up > 0 and level < 5:
            score[up] += points / (1, 2, 6, 9, 12)[level]
            up, level = page.parent[up], level + 1
    if not found:
        return ""
    for i in range(n - 1, 0, -1):                      # parents come before children
        size[page.parent[i]] += size[i]
        link[page.parent[i]] += link[i]
    total = [0.0] * n
    for i in range(1, n):
        if score[i]:
            total[i] = (score[i] + BASE.get(page.tag[i], 0.0) + page.weight[i]) * (1 - link[i] / max(1, size[i]))
    best = max(range(n), key=lambda i: (total[i], -i))
    if total[best] <= 0:
        best = max(range(n), key=lambda i: (page.tag[i] in ("article", "main", "body"), size[i], i))
    while page.tag[best] in ("tr", "tbody", "thead", "tfoot", "li", "dt", "dd"):
        best = page.parent[best]                       # rows and list items are parts, not containers
    up = best
    while up > 0 and page.tag[up] not in ("article", "main"):
        up = page.parent[up]
    article = up > 0
    best = up if article else best
    keep = {best}
    if article:                                        # other articles beside it, and what main says outside of it
        bar = max(5.0, 0.3 * score[best])
        for i in range(1, n):
            if page.parent[i] == page.parent[best] and i != best and not off[i]:
                dense = link[i] / max(1, size[i])
                if (page.tag[i] == page.tag[best] and score[i] * (1 - dense) >= bar) or (
                        page.tag[page.parent[i]] == "main" and page.tag[i] in ("p", "blockquote", "pre")
                        and size[i] >= 25 and dense < 0.25):
                    keep.add(i)
    elif page.parent[best] >= 0:
        bar = max(10.0, 0.2 * total[best])
        for i in range(1, n):
            if page.parent[i] == page.parent[best] and i != best and not off[i]:
                dense = link[i] / max(1, size[i])
                if total[i] >= bar or (page.tag[i] in HEADINGS and size[i]) or (
                        page.tag[i] in ("p", "blockquote", "pre", "ul", "ol", "table") and dense < 0.25):
                    keep.add(i)
    anchors = [0] * n
    for i in range(n - 1, 0, -1):
        anchors[i] += page.tag[i] == "a"
        anchors[page.parent[i]] += anchors[i]
    inside, out = [False] * n, []
    for i in range(1, n):
        inside[i] = i in keep or inside[page.parent[i]]
        if inside[i] and i not in keep and anchors[i] >= 2 and link[i] > 0.5 * max(1, size[i]) and page.tag[i] in (
                "ul", "ol", "dl", "div", "section", "table"):
            inside[i] = False                          # a list of links
    inside[0] = 0 in keep
    for node, words in found:
        if inside[node] or 0 in keep:
            out.append(words)
    return "\n\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""

    def run(batches):
        for b in batches:
            texts = [main_text(h) for h in as_text(b.column(2)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
