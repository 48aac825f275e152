"""Main text of web pages by site template removal.

Each page is parsed into a tree of elements. A subtree's hash covers its tag, its class, its words and its
children, so that equal menus, notices and footers of a site have equal hashes. Spark counts for every
host on how many pages a subtree of the whole page occurs. Template, and deleted before anything else, is

* an outermost subtree beside the main text, never inside it, on ``OUTSIDE_PAGES`` pages and ``OUTSIDE_SHARE`` of the
  host's pages or more (hence a host has at most a few hundred times as many as a page has such elements), and
* a subtree on ``MIN_PAGES`` pages or more and on ``MIN_SHARE`` of the host's pages, wherever it stands.

Names decide what counts cannot: elements that can only hold furniture (navigation, forms, scripts, ...) and
elements whose class, id or role says so, unless such an element holds most of the words around it. The text comes
from the page's ``article`` elements, or ``main``, if they hold at least half of the words that are left, else from
the whole page. Blocks (paragraphs, headings, list items, cells, ...) end where a block element begins or
ends; white space inside a block becomes one space, blocks are joined by one space.

Copies of an article on one host count as one page, so that they do not turn its text into template. Null and
empty pages give an empty text; a null url is a host of its own. Repeated rows are pages of their own.
Extra columns are ignored. An empty table gives an empty table. Work is in proportion to the page, however deep
its elements are nested.
"""

import re
from functools import lru_cache
from hashlib import blake2b
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import stored

MIN_PAGES = 5
MIN_SHARE = 0.5
OUTSIDE_PAGES = 3
OUTSIDE_SHARE = 0.005

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template noscript head title iframe object svg math canvas audio video select textarea datalist".split())
FURNITURE = frozenset("nav header footer aside form button dialog menu search".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# A tag that ends open elements of the named kinds when it starts.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# A class or id that contains one of the words; ``has-``, ``with-`` and the like say something about another element.
MARKS = re.compile(
    r"(?:^|\s)(?!(?:has|with|no|without|is)[_-])(?:[\w]+[_-])*?(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|"
    r"notices?|popup|modal|overlay|newsletter|subscri\w+|sidebar|widgets?|related[_-](?:posts?|articles?|links?|stories)|nav|navbar|navigation|"
    r"menu|breadcrumbs?|masthead|header|footer|comments?|commentlist|disqus|replies|respond|share|sharing|login|signup|search|pagination|"
    r"pager|toolbar)(?:$|[\s_-])",
    re.I,
)
_PARAGRAPH_ENDERS = BLOCKS - {"body", "html"}


class Node:
    __slots__ = ("tag", "marks", "parts", "hidden", "children", "own", "words", "gone", "hash")

    def __init__(self, tag: str, marks: str = "", hidden: bool = False):
        self.tag, self.marks, self.hidden = tag, marks, hidden
        self.parts: list = []  # texts and nodes, in page order
        self.children: list[Node] = []
        self.own = self.words = 0  # words in its own texts; words below it that are not gone
        self.gone = False


class TreeBuilder(HTMLParser):
    """A forgiving tree: end tags close the nearest open element of their name, others are ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}  # where elements of a name are open

    def updatepos(self, i, j):
        return j  # nobody asks for line numbers

    def handle_starttag(self, tag, attrs):
        if tag == "html" or (tag == "body" and self.places.get(tag)):
            return
        if tag in _PARAGRAPH_ENDERS and self.places.get("p"):
            self._close(("p",), stop=("table", "button", "object"))
        if tag in ENDS:
            self._close(ENDS[tag], stop=("table", "ul", "ol", "dl", "select"))
        if attrs:
            known = dict(attrs)
            marks = f"{known.get('class') or ''} {known.get('id') or ''}"
            role = (known.get("role") or "").lower()
            style = (known.get("style") or "").replace(" ", "").lower()
            hidden = "hidden" in known or role in ROLES or (known.get("aria-hidden") or "").lower() == "true" or "display:none" in style
            node = Node(tag, marks, hidden)
        else:
            node = Node(tag, " ")
        above = self.open[-1]
        above.parts.append(node)
        above.children.append(node)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def _last(self, tags) -> int:
        last = 0
        for tag in tags:
            if (found := self.places.get(tag)) and found[-1] > last:
                last = found[-1]
        return last

    def _close(self, tags, stop=()):
        at = self._last(tags)
        if at and at > self._last(stop):
            while len(self.open) > at:
                self.places[self.open.pop().tag].pop()

    def handle_endtag(self, tag):
        if tag in ("html", "body"):
            return
        self._close((tag,))

    def handle_data(self, data):
        self.open[-1].parts.append(data)


def parse(html: str) -> Node:
    for text in (html, re.sub(r"<!\[", "&lt;![", html)):
        builder = TreeBuilder()
        try:
            builder.feed(text)
            builder.close()
            return builder.root
        except AssertionError:  # the standard parser gives up on some malformed declarations
            continue
    root = Node("html")
    root.parts.append(unescape(re.sub(r"<[^>]*>", " ", html)))
    return root


@lru_cache(1 << 12)
def _marked(marks: str) -> bool:
    return bool(marks.strip() and MARKS.search(marks))


def furniture(node: Node) -> bool:
    """The element says itself that it is not main text."""
    return node.tag in SILENT or node.tag in FURNITURE or node.hidden or (node.marks != " " and _marked(node.marks))


_MASK = (1 << 64) - 1


def _mixed(x: int) -> int:
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return x ^ (x >> 31)


def text_hash(text: str) -> int:
    """A stable 64-bit hash of a short string."""
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


@lru_cache(1 << 14)
def _name_hash(tag: str, marks: str) -> int:
    return text_hash(f"{tag} {marks}")


def counted_nodes(root: Node, hashes: bool = True) -> list[Node]:
    """Every element, children before parents, with its own words and the hash of its subtree; no recursion."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += node.children
    order.reverse()
    for node in order:
        value = _name_hash(node.tag, node.marks) if hashes else 0
        texts, own = "", 0
        for part in node.parts:
            if isinstance(part, str):
                words = part.split()
                own += len(words)
                if hashes:
                    if texts:  # texts that only a comment or the like divides
                        words = (texts := texts + part).split()
                    else:
                        texts = part
                    spaced = " ".join(words)
            elif hashes:
                if texts and spaced:
                    value = _mixed(value * 31 + text_hash(spaced) & _MASK)
                texts = ""
                value = _mixed(value * 33 + part.hash & _MASK)
        if texts and spaced:
            value = _mixed(value * 31 + text_hash(spaced) & _MASK)
        node.own, node.hash = own, value
    return order


class Page:
    """A parsed page, with the words of its elements counted and template and furniture marked as gone."""

    def __init__(self, html: str, template: set[int] | None = None, names: bool = True, hashes: bool = True):
        self.root = parse(html)
        self.nodes = counted_nodes(self.root, hashes or bool(template))  # children first
        for node in self.nodes:
            if node.tag in SILENT or (template and node.hash in template):
                node.gone = True
        self._count()
        if names:
            self._drop_named()
        self.content = self._content(names)

    def _count(self) -> None:
        for node in self.nodes:
            below = 0
            if not node.gone:
                below = node.own
                for child in node.children:
                    below += child.words
            node.words = below

    def _drop_named(self) -> None:
        """Furniture goes, unless it holds most of the words of what it stands in: an article's body or a page's wrapper."""
        around = {id(self.root): self.root.words}
        dropped = False
        for node in reversed(self.nodes):  # parents first
            if not node.children:
                continue
            held = around[id(node)]
            for part in node.children:
                if not part.gone and furniture(part):
                    if part.tag in ("nav", "footer", "aside", "button", "dialog", "menu") or 2 * part.words <= held:
                        part.gone = dropped = True
                if part.children:
                    around[id(part)] = part.words if part.tag in ("article", "main") else held
        if dropped:
            self._count()

    def _content(self, names: bool) -> list[Node]:
        """The outermost articles, else main elements, if they hold half of the words left; else the whole page."""
        whole = self.root.words
        for wanted in ("article", "main") if names else ():
            stack, found = [self.root], []
            while stack:
                node = stack.pop()
                if node.gone:
                    continue
                if node.tag == wanted:
                    found.append(node)
                else:
                    stack += reversed(node.children)
            if found and 2 * sum(node.words for node in found) >= whole:
                return found
        return [self.root]

    def text(self) -> str:
        blocks, held = [], []

        def end():
            words = " ".join("".join(held).split())
            if words:
                blocks.append(words)
            held.clear()

        # entries: a text, a node to enter, or None where a block ends
        stack: list = list(reversed(self.content))
        while stack:
            part = stack.pop()
            if part is None:
                end()
            elif isinstance(part, str):
                held.append(part)
            elif not part.gone:
                if part.tag in BLOCKS:
                    end()
                    stack.append(None)
                elif part.tag == "br":
                    held.append("\n")
                stack += reversed(part.parts)
        end()
        return " ".join(blocks)

    def subtrees(self) -> tuple[int, dict[int, bool]]:
        """Hash of the main text's trees; hashes of subtrees with words, and whether they stand in the main text.

        Of what lies beside the main text only the outermost elements are listed. A page that is main text as a whole is
        all inside.
        """
        wordy, found, content = set(), {}, 0
        chosen = {id(node) for node in self.content}
        above = set(chosen)  # what holds main text
        for node in self.nodes:
            if node.tag not in SILENT and (node.own or any(id(x) in wordy for x in node.children)):
                wordy.add(id(node))
            if any(id(x) in above for x in node.children):
                above.add(id(node))
        stack = [(self.root, False)]
        while stack:
            node, inside = stack.pop()
            if id(node) not in wordy:
                continue
            inside = inside or id(node) in chosen
            within = inside or id(node) in above
            if node.tag not in ("html", "body", "article", "main") and (inside or not within):
                found[node.hash] = found.get(node.hash, False) or inside
            if within:
                stack += [(x, inside) for x in node.children]
        for node in self.content:
            content = _mixed(content * 33 + node.hash & _MASK)
        return content, found


def main_text(html: str, template: set[int] | None = None, names: bool = True) -> str:
    """Blocks of the main text. ``template``: hashes of the host's recurring subtrees; without ``names`` only those go."""
    return Page(html, template, names, hashes=False).text()


def _listed(batches):
    """(host, content, subtree, inside): which subtrees stand on which page, 0 for the page as such."""
    for batch in batches:
        hosts, contents, trees, inside = [], [], [], []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            content, found = Page(html or "").subtrees()
            found[0] = False
            hosts += [host] * len(found)
            contents += [content] * len(found)
            trees += found
            inside += found.values()
        numbers = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (contents, trees)]
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.int64()), *numbers, pa.array(inside, pa.bool_())], ["host", "content", "subtree", "inside"])


def site_templates(
    pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, outside_pages: int = OUTSIDE_PAGES
) -> DataFrame:
    """(host, subtree): hashes of the subtrees that are template on the host.

    Pages with equal main texts count once, so that copies of an article do not make it a template.
    """
    rows = pages.select(F.xxhash64(host_of(F.col("url"))).alias("host"), "html").mapInArrow(
        _listed, "host bigint, content bigint, subtree bigint, inside boolean"
    )
    once = rows.groupBy("host", "content", "subtree").agg(F.bool_or("inside").alias("inside"))
    counts = stored(once.groupBy("host", "subtree").agg(F.count("*").alias("n"), F.bool_or("inside").alias("inside")), "subtrees")
    total = counts.where("subtree = 0").select("host", F.col("n").alias("pages"))
    often = counts.where((F.col("subtree") != 0) & (F.col("n") >= min(min_pages, outside_pages))).join(total, "host")
    everywhere = (F.col("n") >= min_pages) & (F.col("n") >= F.col("pages") * min_share)
    beside = ~F.col("inside") & (F.col("n") >= outside_pages) & (F.col("n") >= F.col("pages") * OUTSIDE_SHARE)
    return often.where(everywhere | beside).select("host", "subtree")


def _cleared(batches):
    """Texts of pages; ``found`` lists those of the page's subtrees that are template."""
    for batch in batches:
        texts = []
        for html, found in zip(batch.column("html").to_pylist(), batch.column("found").to_pylist(), strict=True):
            texts.append(main_text(html or "", {t & _MASK for t in found} if found else None))
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def extract_pages(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Two passes over the pages: one counts subtrees, one deletes and extracts. The lists per host are
    stored, so Spark knows their size when it chooses the join.
    """
    templates = site_templates(pages, min_pages, min_share)
    templates = stored(templates.groupBy("host").agg(F.collect_list("subtree").alias("found")), "templates")
    rows = pages.select("page_id", "url", "html", F.xxhash64(host_of(F.col("url"))).alias("host"))
    kind = dict(pages.dtypes)["page_id"]
    return rows.join(templates, "host", "left").select("page_id", "url", "html", "found").mapInArrow(
        _cleared, f"page_id {kind}, url string, text string, n_chars bigint"
    )
