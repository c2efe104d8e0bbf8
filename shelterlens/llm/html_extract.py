"""Main text of web pages by site template removal.

1. Every page is parsed whole; every element subtree has a hash of its tag, its text and
   its children. Spark counts on how many pages of a host each subtree occurs, copies of
   one page (pages that alone yield the same text) counting once; what recurs on many of
   them is template and is deleted on every page. Inside an article only what stands on
   half of a larger host's pages, or nearly all of a smaller one's, counts as template, so
   that a paragraph which several articles share stays. Outside articles subtrees are also
   counted by their place (tags and classes above, tags below) with link text and the numbers
   beside it left out: a place on many pages whose content mostly recurs - a menu, whose links
   may differ, or a footer or advert that rotates - is template, unless it holds a large
   part of the text.
2. Of what the counts leave, the page's own marks go: navigation, header, footer, aside,
   form and the like, and elements with a class or id that as a whole names an advert, a
   notice, a sidebar, a menu or reader comments (``ad``, ``cookie-notice``, ``comment-12``,
   not ``no-sidebar``) - that also covers hosts with too few pages to count. A name alone
   never takes the article or most of the page's text, and on a host with enough pages it
   must stand on several of them (``Judge``).
3. If an ``article`` (else ``main``) holds a fair part of the text still left, only that
   stays. Where it holds less, its elements are teasers or the like and all the rest stays.

Scripts, styles, form controls and the like are no text at any step.

Defined results: null or empty html gives an empty text; broken and cut-off markup is
read as browsers do in the main (implied ends, unclosed elements); repeated rows are
extracted alike and counted as one page; a null url is a host of its own, "".
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
import zlib
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelterlens.llm import common as C
from shelterlens.session import materialize

OUTSIDE_SHARE, OUTSIDE_PAGES = 0.1, 3    # outside the article: template from this share and number of distinct pages on
INSIDE_SHARE, INSIDE_PAGES = 0.9, 3      # inside the article
LARGE_SHARE, LARGE_PAGES = 0.5, 20       # inside the article, on hosts of this many distinct pages and more
PLACE_SHARE, PLACE_TEXT = 0.5, 0.25      # a place is template if this share of its pages shows there what others show too
                                         # and it holds at most this share of their text
SLOT_PAGES, JUDGED_PAGES = 3, 10         # pages that confirm a name, on hosts of this many pages and more
LONG_TEXT = 1000                         # characters that no name but comments takes from beside a much shorter article
HINT_SHARE = 1 / 3                       # an article is followed if it holds this share of the text left
SALTS = 16

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s "
             "samp small span strike strong sub sup time tt u var wbr label".split())
NO_TEXT = set("head script style noscript template iframe object embed svg math canvas button select option textarea "
              "input audio video map title noembed noframes xmp".split())
MARKED = set("nav footer aside form dialog menu".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
               "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"},
            "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = set("article section main table ul ol dl div td th body html aside nav header footer form blockquote".split())
NAMED = set("ad ads adv advert adverts advertisement advertisements adsense banner promo promoted sponsor sponsored "
            "cookie cookies consent gdpr notice notices sidebar sidebars menu menus nav navbar navigation breadcrumb "
            "breadcrumbs comment comments disqus respond replies share sharing social related recommended newsletter "
            "subscribe subscription popup modal overlay footer masthead pagination pager toolbar login signup "
            "skip".split())
COMMENTS = set("comment comments disqus respond replies".split())
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar "
            "note".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z/][^>]*\Z""", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""")
_SPLIT = re.compile(r"[^a-z0-9]+")
_CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DIGITS = re.compile(r"\d+")
_RAW_END = {t: re.compile(rf"</{t}\s*/?>", re.I) for t in RAW}
_MASK = (1 << 64) - 1
LIMITED = set("p li h1 h2 h3 h4 h5 h6".split())      # a closing tag of these ends nothing beyond the innermost SCOPE element
WHOLE = set("# html body article main".split())      # never template as a whole


OUTSIDE, INSIDE, SLOT, PLACE = 0, 1, 2, 3     # what a hash stands for


class Link(str):
    """A piece of text inside a link."""
    __slots__ = ()


class Node:
    __slots__ = ("tag", "drop", "mark", "parts", "inside", "hash", "size", "art", "up", "path", "place", "live", "free",
                 "within")

    def __init__(self, tag, drop=False, mark="", inside=False, up=0, path=0):
        self.tag, self.drop, self.mark, self.inside, self.parts, self.hash = tag, drop, mark, inside, [], None
        self.up, self.path, self.place, self.size, self.art = up, path, None, 0, 0


def _name(value: str) -> str:
    """The first class or id made of nothing but NAMED words (and numbers), "" if there is none."""
    for one in value.split():
        words = [w for w in _SPLIT.split(one) if w and not w.isdigit()]
        if words and NAMED.issuperset(words):
            return "-".join(words)
    return ""


def _marked(tag: str, attrs: str, in_article: bool) -> str:
    """How the page itself marks this element as something else than the article: "#" by
    its tag, role or style, "tag.name" by a class or id, "" not at all."""
    if tag in MARKED or (tag == "header" and not in_article):
        return "#"
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return ""
    named = ""
    for name, a, b, c, bare in _ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if bare or name == "aria-hidden" and value == "true":
            return "#"
        if name in ("class", "id") and tag not in ("html", "body") and not named and (own := _name(value)):
            named = f"{tag}.{own}"
        if name == "role" and value in ROLES:
            return "#"
        if name == "style" and "display:none" in value.replace(" ", ""):
            return "#"
    return named


def _tags(text: str):
    """(start, end, closing, tag, attributes) of all tags; what scripts and the like hold is passed over."""
    at = text.find("<")
    while at >= 0:
        m = _TAG.match(text, at)
        if m is None:
            at = text.find("<", at + 1)
            continue
        slash, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        stop = m.end()
        if tag:
            tag = tag.lower()
            if tag in RAW and not slash:
                end = _RAW_END[tag].search(text, stop)
                stop = end.end() if end else len(text)
        yield at, stop, slash, tag, attrs
        at = text.find("<", stop)


def _inline_ends(text: str) -> tuple[dict[int, tuple[int, int]], list[int]]:
    """Start of each closed inline element -> (start, end) of its own closing tag, and the places of all other tags."""
    opened, ends, others = {}, {}, []
    for start, stop, slash, tag, _ in _tags(text):
        if tag not in INLINE:
            if tag:
                others.append(start)
        elif not slash:
            opened.setdefault(tag, []).append(start)
        elif opened.get(tag):
            ends[opened[tag].pop()] = (start, stop)
    return ends, others


def tree(text: str) -> list[Node]:
    """The elements in page order, the root first; text pieces are decoded, inline elements only
    lend their text. ``up`` is an element's parent by its place in the list. Linear in the page
    however deep it is nested: open elements are looked up by tag, not by walking the stack."""
    root = Node("#")
    nodes, stack, at = [root], [0], 0
    opened, scopes = {}, [0]            # places on the stack by tag; those of SCOPE elements
    inline, link = None, 0              # link: height of the stack where a link is open

    def write(raw: str):
        top = nodes[stack[-1]]
        if raw and not top.drop:
            raw = html_lib.unescape(raw) if "&" in raw else raw
            top.parts.append(Link(raw) if link else raw)

    def close(height: int):
        while len(stack) > height:
            tag = nodes[stack.pop()].tag
            opened[tag].pop()
            if tag in SCOPE:
                scopes.pop()

    def last(tags) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    for start, stop, slash, tag, attrs in _tags(text):
        if start < at:
            continue                    # inside an inline element that went as a whole
        write(text[at:start])
        at = stop
        if not tag:
            continue
        if slash:
            if tag == "a":
                link = 0
            if tag in INLINE and tag != "br":
                continue
            k = last((tag,))
            if k and (tag not in LIMITED or k > scopes[-1]):
                close(k)
                link = link if link <= len(stack) else 0
            continue
        if tag in RAW:
            continue
        top = nodes[stack[-1]]
        if tag in INLINE or tag in VOID:
            if tag in ("br", "img", "hr"):
                write(" ")
                if tag == "hr" and not top.drop:
                    nodes.append(Node("hr", up=stack[-1], inside=top.inside))
                    top.parts.append(nodes[-1])
            elif tag in INLINE and (mark := _marked(tag, attrs, top.inside)):
                inline = inline or _inline_ends(text)        # an inline advert or hidden span
                end = inline[0].get(start)
                if end and mark != "#":
                    k = bisect_left(inline[1], stop)
                    if k < len(inline[1]) and inline[1][k] < end[0]:
                        continue        # it goes round whole elements: no inline advert
                    if not top.drop:
                        node = Node(tag, mark=mark, inside=top.inside, up=stack[-1])
                        node.parts.append(html_lib.unescape(_TAG.sub(" ", text[stop:end[0]])))
                        top.parts.append(node)
                        nodes.append(node)
                at = end[1] if end else at
            elif tag == "a" and attrs:
                link = len(stack)
            continue
        if tag in CLOSES_P and (k := last(("p",))) > scopes[-1]:
            close(k)
        if tag in SIBLINGS and (k := last(SIBLINGS[tag])) > last(("ul", "ol", "dl", "table", "select")):
            close(k)
        link = link if link <= len(stack) else 0
        top = nodes[stack[-1]]
        inside = top.inside or tag in ("article", "main")
        node = Node(tag, top.drop or tag in NO_TEXT, _marked(tag, attrs, top.inside), inside, stack[-1],
                    zlib.crc32(f"{tag} {_classes(attrs)}".encode("utf-8", "surrogatepass"), top.path))
        if not node.drop:
            top.parts.append(node)
        if not attrs.rstrip().endswith("/") or tag not in ("svg", "path"):
            if tag in SCOPE:
                scopes.append(len(stack))
            opened.setdefault(tag, []).append(len(stack))
            stack.append(len(nodes))
        nodes.append(node)
    write(text[at:])
    return nodes


def _classes(attrs: str) -> str:
    """Classes of an element, numbers in them left out."""
    m = _CLASS.search(attrs) if attrs else None
    return " ".join(sorted(_DIGITS.sub("", m[1] or m[2] or m[3] or "").split())) if m else ""


def slot(mark: str) -> int:
    return _digest(f"slot\n{mark}")


def _digest(text: str) -> int:
    raw = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def hashed(nodes: list[Node]) -> tuple[dict[int, int], dict[int, tuple[int, int]]]:
    """Hashes of all subtrees with text, each with whether it lies inside an article on this
    page (OUTSIDE, INSIDE), and hashes of the names that mark elements (SLOT); and for each
    place outside articles (tags and classes of the ancestors, tags below) the hash of
    what stands there and its length. There text in links is left out, and numbers
    beside links are, so that the menus of two pages are equal. All of a page's elements of one
    place count together."""
    found, places = {}, {}
    shapes: list[set] = [None] * len(nodes)
    texts, plain, sizes, linked = [""] * len(nodes), [""] * len(nodes), [0] * len(nodes), [False] * len(nodes)
    index = {id(n): i for i, n in enumerate(nodes)}
    for i in range(len(nodes) - 1, -1, -1):     # children before parents
        node = nodes[i]
        if node.drop or node.tag in INLINE:
            if node.mark not in ("", "#"):
                found[slot(node.mark)] = SLOT
            continue
        run, free, inner, own, shape = [], [], [], [], set()
        size, link = 0, False

        def flush():
            nonlocal size
            if t := _clean(run):
                inner.append(t)
                size += len(t)
                shape.add("#")
            if t := _clean(free):
                own.append(t)

        for p in node.parts:
            if not isinstance(p, Node):
                run.append(p)
                if type(p) is Link:
                    link = link or not p.isspace()
                else:
                    free.append(p)
                continue
            if p.tag in INLINE:
                continue
            flush()
            k = index[id(p)]
            if texts[k]:
                inner.append(texts[k])
                own.append(plain[k])
                size, link = size + sizes[k], link or linked[k]
                shape.add(shapes[k])
        flush()
        if node.mark not in ("", "#"):
            found[slot(node.mark)] = SLOT
        if not inner:
            continue
        node.hash = _digest(f"{node.tag}\n{'\n'.join(inner)}")
        texts[i], sizes[i], linked[i] = f"{node.hash & _MASK:016x}", size, link
        shapes[i] = f"{node.tag}{zlib.crc32(' '.join(sorted(shape)).encode('utf-8', 'surrogatepass'))}"
        rest = "\n".join(own)
        rest = _DIGITS.sub("0", rest) if link else rest
        plain[i] = f"{_digest(rest) & _MASK:016x}" if any(map(str.isalpha, rest)) and own else ""
        if node.tag in WHOLE:
            continue
        found[node.hash] = min(found.get(node.hash, INSIDE), INSIDE if node.inside else OUTSIDE)
        if not node.inside:
            node.place = (node.path - (1 << 31) << 32) + zlib.crc32(shapes[i].encode("utf-8", "surrogatepass"))
            value, held = places.get(node.place, (0, 0))
            add = int(plain[i], 16) if plain[i] else 0
            places[node.place] = (value + add & _MASK >> 1, held + size)
    return found, places


def _clean(run: list[str]) -> str:
    text = " ".join("".join(run).split())
    run.clear()
    return text


def _blocks(top: Node, kept) -> list[str]:
    """Text blocks of the kept elements in page order."""
    out, run = [], []

    def close():
        if t := _clean(run):
            out.append(t)

    todo = [iter(top.parts)]
    while todo:
        for p in todo[-1]:
            if not isinstance(p, Node):
                run.append(p)
            elif p.tag in INLINE:
                run.extend(p.parts if kept(p) else ())
            else:
                close()
                if kept(p):
                    todo.append(iter(p.parts))
                    break
        else:
            close()
            todo.pop()
    return out


def _outermost(top: Node, name: str, kept) -> list[Node]:
    found, todo = [], [top]
    while todo:
        n = todo.pop()
        if n.tag == name:
            found.append(n)
        else:
            todo += [p for p in reversed(n.parts) if isinstance(p, Node) and kept(p)]
    return found


class Judge:
    """What a host's counts say: hashes of recurring subtrees outside and inside articles, places whose
    content recurs, names confirmed by standing on several pages, whether the host has pages enough to tell."""

    def __init__(self, outside=(), inside=(), places=(), slots=(), judged=False):
        self.outside, self.inside, self.places = set(outside or ()), set(inside or ()), set(places or ())
        self.slots, self.judged = set(slots or ()), judged

    def recurs(self, n: Node) -> bool:
        """The counts take the element."""
        return n.hash in self.inside or not n.inside and (n.hash in self.outside or n.place in self.places)

    def open(self, n: Node) -> bool:
        """Neither recurring nor marked by tag, role or style."""
        return n.mark != "#" and not self.recurs(n)

    def weigh(self, nodes: list[Node], name: str) -> int:
        """Set size and art of all open nodes: their text, and what of it ``name`` elements
        hold. Returns how much of the latter lies in no named element."""
        plain = 0
        for i, n in enumerate(nodes):
            up = nodes[n.up]
            n.live = not n.drop and (not i or up.live and self.open(n))
            if not n.live:
                continue
            n.free, n.within = not n.mark and (not i or up.free), n.tag == name or i > 0 and up.within
            n.size = sum(len(p.strip()) for p in n.parts if not isinstance(p, Node))
            n.art = 0
            plain += n.size if n.free and n.within else 0
        for i in range(len(nodes) - 1, 0, -1):
            n = nodes[i]
            if n.live:
                n.art = n.size if n.tag == name else n.art
                nodes[n.up].size += n.size
                nodes[n.up].art += n.art
        return plain

    def follows(self, n: Node, top: Node, plain: int) -> bool:
        """Whether a named element goes. ``plain``: article text outside of named elements."""
        if self.judged and slot(n.mark) not in self.slots:
            return False
        if 2 * n.size <= top.size and 2 * n.art <= top.art:
            return True
        # the name is not alone if the page marks an article elsewhere: short text goes, and comments of any length
        return plain > 0 and (n.size < LONG_TEXT or HINT_SHARE * n.size <= plain
                              or not COMMENTS.isdisjoint(n.mark.split(".")[1].split("-")))


def chosen(nodes: list[Node], judge: Judge = Judge(), marks: bool = True) -> list[str]:
    """Blocks of the page's main text: without what the host's counts take, then without
    marked elements, then the articles alone if they hold a fair part of what is left.
    ``marks=False`` stops after the counts."""
    top = nodes[0]
    if not marks:
        return _blocks(top, lambda n: not judge.recurs(n))
    plain = judge.weigh(nodes, "article")
    if not top.art:
        plain = judge.weigh(nodes, "main")

    def kept(n):
        return judge.open(n) and not (n.mark and judge.follows(n, top, plain))

    left = _blocks(top, kept)
    size = sum(map(len, left))
    for name in ("article", "main"):
        own = [b for r in _outermost(top, name, kept) for b in _blocks(r, kept)]
        if own and sum(map(len, own)) >= HINT_SHARE * size:
            return own
    return left


def page_blocks(text: str):
    """Blocks that the page alone yields, without counts of its host, and its subtree hashes."""
    nodes = tree(text)
    return [(t, ()) for t in chosen(nodes)], hashed(nodes)[0]


def content_of(nodes: list[Node]) -> int:
    """Hash of the text that the page alone yields: copies under other addresses, with other
    navigation or adverts, have the same."""
    return _digest("\n".join(chosen(nodes)))


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


# ---------------------------------------------------------------- Spark
def _contents(batches):
    """(host, content, subtrees, kinds, places, values, sizes, size): hashes on the pages of one
    content, copies of a batch as one."""
    import pyarrow as pa

    for batch in batches:
        seen = {}
        for url, text in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            nodes = tree(text or "")
            found, places = hashed(nodes)
            size = sum(len(p) for n in nodes if not n.drop for p in n.parts if not isinstance(p, Node))
            held = seen.setdefault((host_of(url), content_of(nodes)), ({}, {}))
            _merge(held[0], found.items())
            _merge(held[1], ((k, (*v, size)) for k, v in places.items()))
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.int64()),
             pa.array([list(f) for f, _ in seen.values()], longs),
             pa.array([bytes(f.values()) for f, _ in seen.values()], pa.binary()),
             pa.array([list(p) for _, p in seen.values()], longs),
             *(pa.array([[v[k] for v in p.values()] for _, p in seen.values()], longs) for k in range(3))],
            names=[f.split()[0] for f in CONTENT.split(", ")])


CONTENT = ("host string, content long, subtrees array<bigint>, kinds binary, places array<bigint>, "
           "values array<bigint>, sizes array<bigint>, whole array<bigint>")


def _merge(held: dict, found) -> None:
    for h, v in found:
        held[h] = min(held.get(h, v), v)


COUNTED = "host string, subtree long, kind int, value long, pages long, chars long, whole long"


def _count(batches):
    """(host, subtree, kind, value, pages, chars, whole) of contents that arrive in order; subtree null counts
    the contents, kind PLACE the contents with this value at the place ``subtree``."""
    import pyarrow as pa

    last, held, places = None, {}, {}

    def add(seen):
        if last is None:
            return
        for h, kind in ((None, OUTSIDE), *held.items()):
            _plus(seen, (last[0], h, kind, None), 0, 0)
        for place, (value, chars, whole) in places.items():
            _plus(seen, (last[0], place, PLACE, value), chars, whole)

    def rows(seen):
        keys, sums = list(zip(*seen)) or [()] * 4, list(zip(*seen.values())) or [()] * 3
        types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((*keys, *sums), types)],
                                          names=[f.split()[0] for f in COUNTED.split(", ")])

    for batch in batches:
        seen = {}
        for host, content, subtrees, kinds, *at in zip(*(batch.column(f.split()[0]).to_pylist()
                                                         for f in CONTENT.split(", "))):
            if (host, content) != last:
                add(seen)
                last, held, places = (host, content), {}, {}
            _merge(held, zip(subtrees, kinds))
            _merge(places, zip(at[0], zip(*at[1:])))
        yield rows(seen)
    seen = {}
    add(seen)
    yield rows(seen)


def _plus(seen: dict, key: tuple, chars: int, whole: int) -> None:
    n, c, w = seen.get(key, (0, 0, 0))
    seen[key] = (n + 1, c + chars, w + whole)


JUDGE = ("outside", "inside", "places", "slots", "judged")


def _extract(batches):
    import pyarrow as pa

    for batch in batches:
        out = []
        for text, *counts in zip(*(batch.column(c).to_pylist() for c in ("html", *JUDGE))):
            nodes = tree(text or "")
            if counts[0] or counts[1] or counts[2]:
                hashed(nodes)           # else the host has no template to compare with
            out.append("\n".join(chosen(nodes, Judge(*counts))))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()),
             pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def templates(pages: DataFrame) -> DataFrame:
    """(host, outside, inside, places, slots, judged): what each host's counts say (``Judge``).

    A host's list is bounded: a subtree or place needs a tenth of its distinct pages, so there are at
    most ten times as many as a page has subtrees (more only for hosts of under 30 pages), and
    names come from a fixed vocabulary.
    """
    contents = C.arrow_map(pages.select("url", "html"), _contents, CONTENT)
    contents = contents.repartition("host", "content").sortWithinPartitions("host", "content")
    sums = C.arrow_map(contents, _count, COUNTED).groupBy("host", "subtree", "kind", "value").agg(
        F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), F.sum("whole").alias("whole"))
    least = min(OUTSIDE_PAGES, INSIDE_PAGES, SLOT_PAGES)
    sums = (sums.groupBy("host", "subtree", "kind")
            .agg(F.sum("pages").alias("pages"), F.sum(F.when(F.col("pages") > 1, F.col("pages"))).alias("again"),
                 F.sum("chars").alias("chars"), F.sum("whole").alias("whole")))
    sums = materialize(sums.filter(F.col("subtree").isNull() | (F.col("pages") >= least)))
    total = sums.filter("subtree is null").select("host", F.col("pages").alias("total"))
    kind, seen = F.col("kind"), F.col("pages")
    many = (seen >= OUTSIDE_PAGES) & (seen >= OUTSIDE_SHARE * F.col("total"))
    often = sums.join(total, "host").filter(
        F.col("subtree").isNull()
        | ((kind == OUTSIDE) & many)
        | ((kind == PLACE) & many & (F.col("again") >= PLACE_SHARE * seen)
           & (F.col("chars") <= PLACE_TEXT * F.col("whole")))
        | ((kind == INSIDE) & (seen >= INSIDE_PAGES) & (seen >= F.col("total") * F.when(
            F.col("total") >= LARGE_PAGES, LARGE_SHARE).otherwise(INSIDE_SHARE)))
        | ((kind == SLOT) & (seen >= SLOT_PAGES)))
    lists = [F.collect_set(F.when(kind == k, F.col("subtree"))).alias(name)
             for k, name in ((OUTSIDE, "outside"), (INSIDE, "inside"), (PLACE, "places"), (SLOT, "slots"))]
    return materialize(often.groupBy("host").agg(*lists, (F.max("total") >= JUDGED_PAGES).alias("judged")))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of pages (page_id, url, html)."""
    pages = pages.select("page_id", "url", "html")
    found = templates(pages).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")),
                                    r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/?#:]*)", 1))
    salted = pages.withColumn("host", host).withColumn(
        "salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    met = salted.join(found, ["host", "salt"], "left").select("page_id", "url", "html", *JUDGE)
    return C.arrow_map(met, _extract, "page_id long, url string, text string, n_chars long")
