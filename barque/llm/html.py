"""Main text of web pages by composite text density (operator 3)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAME = re.compile(r"[A-Za-z][^\s/>]*")
STOP = re.compile(r"""[>"']""")
#: Every attribute of a tag in turn, its value whole: nothing is found inside names or values.
ATTRIBUTE = re.compile(r"""([^\s/][^\s/=]*)(?:\s*=\s*(?:"([^"]*)(?:"|$)|'([^']*)(?:'|$)|([^\s>]+)))?""")
WORD = re.compile(r"[A-Za-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg xmp".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
#: What an opening tag ends, up to the nearest of the tags on the right.
ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})), "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})), "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})), "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})), "option": (frozenset({"option"}), frozenset({"select"})),
}
KEEPS_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "legend", "html", "head", "body"}
DROPPED = frozenset("nav footer aside form button select menu dialog head object canvas audio video".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: Words of class and id that mark what surrounds an article: the last word of a name ("site-footer"), or the first where
#: only PLACES follow ("comments-area"). What holds an article or nearly all of the page's text is no surrounding, whatever its
#: name.
DROPPED_NAMES = frozenset("ad ads advert adverts advertisement advertisements advertising banner banners promo promotion sponsor sponsored sponsors sidebar menu menus nav navbar navigation breadcrumb breadcrumbs footer cookie cookies notice notices consent gdpr popup modal overlay newsletter subscribe signup login comment comments disqus respond share sharing social related recommended widget widgets toolbar pagination pager".split())
PLACES = frozenset("area bar bars block blocks body bottom box boxes btn button buttons col column container content first group holder icon icons inner item items last left link links list main outer panel right row section slot text title top unit view wrap wrapper zone".split())
TEXT_ROOTS = frozenset({"article", "main"})
CLOSE = {name: re.compile(f"</{name}(?=[\\s/>]|$)", re.I) for name in RAW}
#: What becomes of a node: it goes; it holds text roots only; its subtrees are judged without or with its own text; it stays.
GONE, OUTSIDE, SPARSE, OPEN, TAKEN = range(5)
NEVER_NAMED = frozenset({"html", "body", "article", "main"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: The form of contributions by readers: siblings of one shape, each a short line that tells a time, and a text below it.
BYLINE, LEAST_ENTRIES, MOST_SHARE = 80, 2, 0.5
TIME_WORD = re.compile(r"\d")


class Scanner:
    """Tags of a page one after the other, in time linear in its length: what was once looked for in vain isn't looked
    for again. A quote counts only where a value begins."""

    def __init__(self, html: str):
        self.html, self.last, self.lacking = html, html.rfind(">"), set()

    def upto(self, what: str, at: int) -> int:
        """Behind the next `what`, or the end of the page."""
        end = -1 if what in self.lacking else self.html.find(what, at)
        if end < 0:
            self.lacking.add(what)
            return len(self.html)
        return end + len(what)

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """(start, end, name, whether it ends an element, attributes) of the first tag from `at` on; comments and
        declarations have no name. A tag that never ends, ends with the page."""
        html = self.html
        while (start := html.find("<", at)) >= 0:
            for opening, closing in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">")):
                if html.startswith(opening, start):
                    return start, self.upto(closing, start + len(opening)), "", False, ""
            ends = html.startswith("/", start + 1)
            m = NAME.match(html, start + 1 + ends)
            if m:
                stop = self.stop(m.end())
                return start, stop + 1, m[0].lower(), ends, html[m.end() : stop]
            at = start + 1
        return None

    def stop(self, at: int) -> int:
        """Where a tag ends whose name ends at `at`."""
        html, j = self.html, at
        while j <= self.last:
            found = STOP.search(html, j)
            j = found.end()
            if found[0] == ">":
                return found.start()
            before = found.start() - 1
            while before >= at and html[before] in " \t\n\r\f":
                before -= 1
            if html[before] == "=" and before >= at and (close := self.upto(found[0], j)) < len(html):
                j = close
        first = html.find(">", at) if at <= self.last else -1  # a quoted value that runs past all tags
        return first if first >= 0 else len(html)


class Page:
    """The tree of one page as parallel lists, in page order; text in pieces with their block and node."""

    def __init__(self, html: str):
        self.tag, self.parent, self.dropped, self.doubtful, self.shape = ["#root"], [0], [False], [False], [""]
        self.pieces: list[tuple[int, int, str]] = []
        self.block = 0
        self.open, self.open_tags = [0], {}
        scanner, at = Scanner(html), 0
        while tag := scanner.next(at):
            start, end, name, ends, attributes = tag
            self.text(html[at:start])
            at = end
            if not name:
                continue
            if ends:
                self.end(name)
                continue
            self.start(name, attributes)
            if name in RAW:
                self.end(name)
                close = CLOSE[name].search(html, at)
                at = close.start() if close else len(html)
        self.text(html[at:])

    def text(self, s: str) -> None:
        if s and not self.dropped[self.open[-1]]:
            self.pieces.append((self.block, self.open[-1], unescape(s)))

    def start(self, name: str, attributes: str) -> None:
        if name in KEEPS_P and self.open_tags.get("p"):
            self.end("p")
        if name in ENDS:
            ended, stop = ENDS[name]
            for i in range(len(self.open) - 1, 0, -1):
                tag = self.tag[self.open[i]]
                if tag in stop:
                    break
                if tag in ended:
                    self.cut(i)
        if name in BLOCK:
            self.block += 1
        elif name == "br":
            self.text(" ")
        above = self.open[-1]
        self.tag.append(name)
        self.parent.append(above)
        dropped, doubtful = self.named(name, attributes)
        kind = next((m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes) if m[1].lower() == "class"), "") if attributes else ""
        self.shape.append(f"{name} {kind}" if kind else "")
        self.dropped.append(self.dropped[above] or name in RAW or name in DROPPED or dropped)
        self.doubtful.append(doubtful)
        if name not in VOID:
            self.open.append(len(self.tag) - 1)
            self.open_tags[name] = self.open_tags.get(name, 0) + 1

    def named(self, name: str, attributes: str) -> tuple[bool, bool]:
        """Whether an element goes by its tag, state or role, and whether its class or id tells of surroundings."""
        inside = any(self.open_tags.get(t) for t in TEXT_ROOTS)
        if name == "header" and not inside:
            return True, False
        if not attributes or name in NEVER_NAMED:
            return False, False
        seen, doubtful = set(), False
        for m in ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key in seen:  # the first of equal names holds
                continue
            seen.add(key)
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in DROPPED_ROLES:
                return True, False
            if key in ("class", "id"):
                for words in map(WORD.findall, value.split()):
                    if words and (words[-1] in DROPPED_NAMES or words[0] in DROPPED_NAMES and PLACES.issuperset(words[1:]) or words[-1] == "header" and not inside):
                        doubtful = True
        return False, doubtful

    def end(self, name: str) -> None:
        if self.open_tags.get(name):
            for i in range(len(self.open) - 1, 0, -1):
                if self.tag[self.open[i]] == name:
                    self.cut(i)
                    break
        elif name in BLOCK:
            self.block += 1

    def cut(self, i: int) -> None:
        for node in self.open[i:]:
            self.open_tags[self.tag[node]] -= 1
            self.block += self.tag[node] in BLOCK
        del self.open[i:]


def tree_sums(page: Page) -> tuple[list[int], list[int], list[int], list[int], list[bool]]:
    """Of every node: characters but spaces, those in links, tags and link tags, all of its whole subtree without what is
    dropped; and whether it stands in a link."""
    n = len(page.tag)
    chars, links, tags, link_tags, in_link = [0] * n, [0] * n, [1] * n, [0] * n, [False] * n
    for i in range(1, n):
        in_link[i] = page.tag[i] == "a" or in_link[page.parent[i]]
        link_tags[i] = int(page.tag[i] == "a")
    for _, node, s in page.pieces:
        if not page.dropped[node]:
            size = len(s) - s.count(" ")
            chars[node] += size
            links[node] += size * in_link[node]
    for i in range(n - 1, 0, -1):
        if not page.dropped[i]:
            up = page.parent[i]
            chars[up] += chars[i]
            links[up] += links[i]
            tags[up] += tags[i]
            link_tags[up] += link_tags[i]
    return chars, links, tags, link_tags, in_link


def contributions(page: Page, chars: list[int]) -> list[int]:
    """Nodes that hold what readers wrote below a text, by form alone: their entries are siblings with the same tag and class,
    none holds a heading or a text root, each begins with a short line with a time (an element for it, or a number) and has
    more below, and together they are not most of the page."""
    n = len(page.tag)
    groups: dict[tuple[int, str], list[int]] = {}
    for i in range(1, n):
        if page.shape[i] and page.tag[i] in BLOCK and not page.dropped[i] and page.tag[i] not in ("tr", "td", "th", "p"):
            groups.setdefault((page.parent[i], page.shape[i]), []).append(i)
    groups = {k: v for k, v in groups.items() if len(v) >= LEAST_ENTRIES}
    if not groups:
        return []
    end = list(range(1, n + 1))
    for i in range(n - 1, 0, -1):
        end[page.parent[i]] = max(end[page.parent[i]], end[i])
    starts: dict[int, list[int]] = {}
    for at, (_, node, _) in enumerate(page.pieces):
        starts.setdefault(node, []).append(at)

    def is_entry(i: int) -> bool:
        tags = page.tag[i : end[i]]
        if not TEXT_ROOTS.isdisjoint(tags) or not HEADINGS.isdisjoint(tags):
            return False
        inside = sorted(at for node in range(i, end[i]) for at in starts.get(node, ()))
        lines: dict[int, str] = {}
        for at in inside:
            block, _, text = page.pieces[at]
            lines[block] = lines.get(block, "") + text
        told = [x for x in (" ".join(x.split()) for x in lines.values()) if x]
        return len(told) > 1 and len(told[0]) <= BYLINE and ("time" in tags or TIME_WORD.search(told[0]) is not None)

    out = []
    for members in groups.values():
        size = sum(chars[i] for i in members)
        if size and size < MOST_SHARE * chars[0] and all(is_entry(i) for i in members):
            out += members
    return out


def density(chars: int, links: int, tags: int, link_tags: int, of_body: float) -> float:
    """Composite text density: characters per tag, made less by links. of_body: the share of link characters in the body."""
    if not chars:
        return 0.0
    base = log(chars / max(chars - links, 1) * links + of_body * chars + e)
    return chars / tags * log(max(chars / max(links, 1) * tags / max(link_tags, 1), 1.0)) / base


def main_text(html: str) -> str:
    """The blocks of the dense subtrees, each on a line.

    For every node: characters per tag, adjusted for links. The node whose children's densities have the largest sum
    is taken, with the outermost article or main element around it. The least density on the way from that node up to the body is
    the threshold: every other subtree of the body that reaches it is taken too, or, where an article or main element
    stands around the node, every other such element that reaches it. Inside what is taken, blocks
    mostly of links under the threshold are left out. Before all this go elements that are no text by their tag, state or
    role, those whose class or id tells of surroundings, unless they hold an article or nearly all of the page's text, and
    what readers wrote, told by its form (see contributions), whatever it is named.
    """
    page = Page(html)
    n = len(page.tag)
    chars, *_ = tree_sums(page)
    holds_root = [tag in TEXT_ROOTS for tag in page.tag]
    for i in range(n - 1, 0, -1):
        holds_root[page.parent[i]] |= holds_root[i]
    in_root = [False] * n
    for i in range(1, n):
        up = page.parent[i]
        in_root[i] = in_root[up] or page.tag[up] in TEXT_ROOTS
        beside = holds_root[0] and not in_root[i] and not holds_root[i]
        goes = page.doubtful[i] and (beside or not holds_root[i] and chars[i] * 10 < chars[0] * 9)
        page.dropped[i] = page.dropped[i] or page.dropped[up] or goes
    wrote = contributions(page, chars)
    above = {e: page.parent[e] for e in wrote}
    beside: dict[int, int] = {}  # text that stands in a container beside its entries
    for i in range(1, n):
        beside[page.parent[i]] = beside.get(page.parent[i], 0) + (0 if i in above else chars[i])
    for entry, up in above.items():
        whole = page.tag[up] not in NEVER_NAMED and beside[up] <= 2 * BYLINE and not holds_root[up]
        page.dropped[up if whole else entry] = True
    for i in range(1, n):
        page.dropped[i] = page.dropped[i] or page.dropped[page.parent[i]]
    chars, links, tags, link_tags, in_link = tree_sums(page)
    body = next((i for i in range(n) if page.tag[i] == "body"), 0)
    of_body = links[body] / max(chars[body], 1)
    densities = [0.0 if page.dropped[i] else density(chars[i], links[i], tags[i], link_tags[i], of_body) for i in range(n)]
    sums = [0.0] * n
    for i in range(1, n):
        sums[page.parent[i]] += densities[i]
    best = max((i for i in range(n) if not page.dropped[i]), key=lambda i: (sums[i], -i))
    if not sums[best]:
        best = body
    threshold, i, root = densities[best], best, -1
    while True:
        threshold = min(threshold, densities[i])
        if page.tag[i] in TEXT_ROOTS:
            root = i
        if i in (0, body):
            break
        i = page.parent[i]
    state = [GONE] * n
    for i in range(n):
        above = state[page.parent[i]] if i else OPEN if root < 0 else OUTSIDE
        if page.dropped[i] or above == GONE and i:
            continue
        if i in (best, root):
            state[i] = TAKEN
        elif above == TAKEN:
            mostly_links = page.tag[i] in BLOCK and links[i] * 2 > chars[i] and densities[i] < threshold
            state[i] = GONE if mostly_links else TAKEN
        elif above == OUTSIDE and page.tag[i] not in TEXT_ROOTS or above == OPEN and (i in (0, body) or page.tag[i] == "html" or page.tag[i] not in BLOCK):
            state[i] = above
        else:
            state[i] = TAKEN if densities[i] >= threshold and (above != SPARSE or page.tag[i] in BLOCK) else SPARSE
    blocks: dict[int, list[str]] = {}
    loose: dict[int, int] = {}
    for block, node, s in page.pieces:
        if state[node] in (TAKEN, OPEN):
            blocks.setdefault(block, []).append(s)
            if state[node] == OPEN:
                loose[block] = loose.get(block, 0) + (len(s) - s.count(" ")) * (-1 if in_link[node] else 1)
    for block, more in loose.items():
        if more < 0:
            del blocks[block]
    lines = (" ".join("".join(x).split()) for x in blocks.values())
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page.

    A null or empty page, or one without text, has an empty text; malformed markup is read as far as it goes; long
    pages are read whole; repeated rows give repeated rows; null ids and urls stay null; other columns are ignored.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return rows.mapInArrow(task, "page_id long, url string, text string, n_chars long")


def op3_html(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
