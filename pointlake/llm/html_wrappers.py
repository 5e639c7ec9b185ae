"""Main text of web pages by wrappers inferred per host.

A page is a stream of tags and texts. Its union-free expression is kept as a tree in
normal form: a node per label (tag, id and classes; digits generalised; unnamed containers by
their place among siblings) and parent, whose further repeats are one repeated group, and whose text is a fixed string or a slot.
Aligning two streams of a host merges their trees: labels on one side only become
optional, labels that come again or in another order become repeated groups, texts that differ
become slots. The normal form names a label once per place, so a wrapper
is bounded by a host's vocabulary of places, not by its pages, and the alignment can be done in any
grouping: tasks fold their own pages first, then partial wrappers are folded per (host, salt),
and those per host. No host is ever gathered in one task.

The wrapper then says what the host's template is: texts that are the same on every page that has
them (with at least ``LEAST_PAGES`` pages, at least half of the parent's, and most of the
text variable; never inside an element named as article or content, nor headings inside the content node), link lists, and, where pages name no article element, the node that holds
most of the variable text. Regions that name themselves (navigation, header, footer, aside, form,
advert, notice, comments ...) are dropped on every page; one that only its names tell to drop stays if it holds
most of the host's variable text. The article element is kept whole where a page has one (unless it is less than half of the
ranked text around it), else all that lies in elements named as content, if that is most of the page's text.

Edge cases: a null or empty html gives an empty text; a null url, or one without a host,
belongs to the host ""; broken markup is closed where HTML implies it, an unfinished tag at
the end is dropped; a host with one page, or copies of one page only, has no template text;
repeated rows give equal texts; pages of any length are read whole; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import html as htmllib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, broadcast_if_small, read_table, store

LEAST_PAGES = 3
#: Share of a host's text that must vary before fixed texts count as template.
VARIABLE = 0.5
#: Share of the variable text that the content node of a page without article holds at least.
MAJORITY = 0.6
#: Share of link text from which a list is a menu.
LINKS = 0.6
SALTS = 64
HELD_HOSTS = 2_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
#: Elements that are told apart by place if they have no name, and how many places there are.
CONTAINERS = frozenset("div section table ul ol dl".split())
PLACES = 8
#: Elements nested deeper than this share the place of the one at this depth.
DEEPEST = 100
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                     "h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: Open elements that a start tag ends, up to the nearest of the bounding elements.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}
BAD_TAGS = frozenset("head nav footer aside form button select dialog menu search object applet "
                     "audio video canvas label fieldset".split()) | RAW
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
BAD_HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot sponsor sponsored promo promotion promoted banner "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
    "sidebar sidebars widget widgets related recommended recommendations share sharing social comment comments commentlist reply "
    "replies respond disqus discussion nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager footer foot "
    "masthead toolbar topbar login search copyright legal disclaimer skip tags tagcloud toc".split())
#: The ones that tell an article element is not the article (one comment, a teaser ...).
ARTICLE_HINTS = frozenset("ad ads advert advertisement sponsored promo related recommended comment comments reply replies".split())
#: Parts of a name that make it a state of the element (no-sidebar, share-enabled), not what it is.
STATES = frozenset("no not without has have with is enabled disabled".split())
HEADER_HINTS = frozenset("header hdr".split())
RANK_TOKENS = {"article": 2, "articlebody": 2, "post": 2, "entry": 2, "story": 2, "content": 1, "main": 1, "maincontent": 1, "text": 1}
#: Elements that are a paragraph, heading or item of a text, whatever their class says.
PARTS = HEADINGS | frozenset("p li dt dd tr pre blockquote figure figcaption address ul ol dl".split())
#: Why an element is dropped: by its names only, or by what it is.
BY_HINT, BY_KIND = 1, 2


@lru_cache(maxsize=50_000)
def tag_facts(tag: str, attributes: str) -> tuple[str, int, bool, int]:
    """(label, why it is dropped or 0, header region, article rank) of a start tag."""
    found = {}
    for m in ATTRIBUTE.finditer(attributes):
        found[(m[1] or m[5]).lower()] = m[2] or m[3] or m[4] or ""
    names = f"{found.get('id', '')} {found.get('class', '')}"
    parted = [frozenset(re.findall(r"[a-z]+", x.lower())) for x in re.sub(r"([a-z])([A-Z])", r"\1-\2", names).split()]
    tokens = set().union(*parted)
    role = found.get("role", "").lower()
    style = found.get("style", "").replace(" ", "").lower()
    header = tag == "header" or bool(tokens & HEADER_HINTS)
    rank = 3 if tag == "article" or role == "article" else max((RANK_TOKENS.get(t, 0) for t in tokens), default=0) if tag not in PARTS else 0
    if tag == "main" or role == "main":
        rank = max(rank, 1)
    if found.get("itemprop", "").lower() == "articlebody":
        rank = max(rank, 2)
    hints = ARTICLE_HINTS if tag == "article" else () if tag in ("body", "html", "main") else BAD_HINTS
    # beside a name that only says article, a name with a state in it is no hint
    article = any(not x.isdisjoint(RANK_TOKENS) and x.isdisjoint(BAD_HINTS) for x in parted)
    hinted = any(not x.isdisjoint(hints) and not (article and not x.isdisjoint(STATES)) for x in parted)
    bad = (BY_KIND if tag in BAD_TAGS or role in BAD_ROLES or "hidden" in found or found.get("aria-hidden") == "true"
           or "display:none" in style or not tokens.isdisjoint(ARTICLE_HINTS) and hinted else BY_HINT if hinted else 0)
    names = " ".join([*found.get("id", "").split(), *sorted(found.get("class", "").split())])
    label = f"{tag} {re.sub(r'[0-9]+', '#', names)}".strip().replace("/", "|")
    return label, bad, header, 0 if bad else rank


def blocks(page: str | None) -> list[tuple[str, str, int, int, tuple[str, ...]]]:
    """(path, text, characters of link text, rank, hinted) of every block with text, in page order.

    path: labels of the enclosing block elements; rank: -1 in a region dropped for what it is, else the highest article
    rank around it; hinted: paths of the enclosing elements that only their names tell to drop."""
    out: list[tuple[str, str, int, int, tuple[str, ...]]] = []
    # tag, path, bad, header, rank, unnamed containers among the children so far, hinted
    stack: list[tuple[str, str, bool, bool, int, dict[str, int], tuple[str, ...]]] = [("", "", False, False, 0, {}, ())]
    parts: list[str] = []
    linked = 0
    in_link = 0
    block = 0  # index in the stack of the block element that text belongs to

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                tag, path, bad, header, rank, _, hinted = stack[block]
                if header and not (rank and tag in HEADINGS):
                    bad = True
                out.append((path, text, linked, -1 if bad else rank, hinted))
            parts, linked = [], 0

    def pop_to(size: int) -> None:
        nonlocal block, in_link
        for tag, *_ in stack[size:]:
            in_link -= tag == "a"
        if size <= block:
            flush()
            block = next(i for i in range(size - 1, -1, -1) if stack[i][0] not in INLINE)
        del stack[size:]

    at, page = 0, page or ""
    while True:
        m = TOKEN.search(page, at)
        piece = page[at:m.start()] if m else page[at:]
        if piece:
            piece = htmllib.unescape(piece)
            if stack[-1][2] or stack[-1][6]:  # a dropped inline region inside a kept block
                if (stack[block][2], stack[block][6]) == (stack[-1][2], stack[-1][6]):
                    parts.append(piece)
            else:
                parts.append(piece)
                linked += len(piece) if in_link else 0
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[4] or "").lower()
        if tag:
            attributes = m[3] if m[2] else m[5]
            if tag not in INLINE and tag in CLOSES_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        pop_to(i)
                        break
                    if stack[i][0] not in INLINE:
                        break
            if tag in IMPLIED:
                ends, bounds = IMPLIED[tag]
                size = 0
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in bounds:
                        break
                    if stack[i][0] in ends:
                        size = i
                if size:
                    pop_to(size)
            if tag in VOID:
                if tag in ("br", "wbr", "hr"):
                    if tag == "hr":
                        flush()
                    elif tag == "br":
                        parts.append(" ")
                continue
            if tag in RAW:
                if not attributes.rstrip().endswith("/"):
                    end = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.I).search(page, at)
                    at = end.end() if end else len(page)
                continue
            label, bad, header, rank = tag_facts(tag, attributes)
            _, path, up_bad, up_header, up_rank, children, hinted = stack[-1]
            if tag not in INLINE:
                flush()
                if label == tag and tag in CONTAINERS:  # nothing but its place tells it from its siblings
                    n = children[tag] = children.get(tag, 0) + 1
                    label = f"{tag}[{min(n, PLACES)}]"
                if tag not in ("html", "body") and path.count("/") < DEEPEST:
                    path = f"{path}/{label}"
                block = len(stack)
            in_link += tag == "a"
            if bad == BY_HINT:
                hinted = (*hinted, path if tag not in INLINE else f"{path}/{label}")
            stack.append((tag, path, up_bad or bad == BY_KIND, up_header or header, max(up_rank, rank), {}, hinted))
        elif m[1]:
            tag = m[1].lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    pop_to(i)
                    break
    flush()
    return out


# --- wrappers: node = [pages, optional, repeated, text, variable chars, fixed chars, link chars, {label: node}]
PAGES, OPTIONAL, REPEATED, TEXT, MOVING, FIXED, LINKED, BELOW = range(8)
SLOT = "*"


def new_node(pages: int = 0) -> list:
    return [pages, 0, 0, None, 0, 0, 0, {}]


def page_wrapper(found: list[tuple[str, str, int, int, tuple[str, ...]]]) -> list:
    """The expression of one page."""
    root = new_node(1)
    opened: list[str] = []
    for path, text, linked, *_ in found:
        labels = path.split("/")[1:]
        node, depth = root, 0
        for label in labels:
            below = node[BELOW].get(label)
            if below is None:
                below = node[BELOW][label] = new_node(1)
            elif depth >= len(opened) or opened[depth] != label or depth == len(labels) - 1:
                below[REPEATED] = 1
            node, depth = below, depth + 1
        opened = labels
        code = xxhash.xxh3_64_hexdigest(text.encode())
        if node[TEXT] is None:
            node[TEXT], node[FIXED] = code, len(text)
        elif node[TEXT] == code:
            node[FIXED] += len(text)
        else:
            node[MOVING] += node[FIXED] + len(text)
            node[TEXT], node[FIXED] = SLOT, 0
        node[LINKED] += linked
    return root


def align(a: list, b: list) -> list:
    """The expression of both: ``b`` merged into ``a``."""
    if a[TEXT] is None or b[TEXT] is None or a[TEXT] == b[TEXT]:
        a[TEXT] = b[TEXT] if a[TEXT] is None else a[TEXT]
        a[MOVING] += b[MOVING]
        a[FIXED] += b[FIXED]
    else:
        a[MOVING] += a[FIXED] + b[FIXED] + b[MOVING]
        a[TEXT], a[FIXED] = SLOT, 0
    a[LINKED] += b[LINKED]
    a[OPTIONAL] |= b[OPTIONAL]
    a[REPEATED] |= b[REPEATED]
    mine, theirs = a[BELOW], b[BELOW]
    for label in mine.keys() - theirs.keys():
        mine[label][OPTIONAL] = 1
    places = {label: i for i, label in enumerate(mine)}
    last = -1
    for label, node in theirs.items():
        if label in mine:
            align(mine[label], node)
            if places[label] < last:  # another order: a repeated group of both
                mine[label][REPEATED] = 1
            last = max(last, places[label])
        else:
            node[OPTIONAL] = 1
            mine[label] = node
    a[PAGES] += b[PAGES]
    return a


def expression(node: list, label: str = "") -> str:
    """The wrapper as a union-free regular expression."""
    text = "" if node[TEXT] is None else "#TEXT" if node[TEXT] == SLOT else f"'{node[TEXT][:6]}'"
    inner = " ".join(x for x in (text, *[expression(n, k) for k, n in node[BELOW].items()]) if x)
    body = f"<{label}> {inner} </{label}>" if label else inner
    mark = {(0, 0): "", (1, 0): "?", (0, 1): "+", (1, 1): "*"}[node[OPTIONAL], node[REPEATED]]
    return f"({body}){mark}" if mark else body


def _label_facts(label: str) -> tuple[int, int]:
    """(why it is dropped or 0, rank) by a label alone, as its start tag gave them."""
    tag, *names = label.partition("[")[0].split(" ")
    _, bad, header, rank = tag_facts(tag, f'class="{" ".join(names)}"')
    return BY_KIND if header else bad, rank


def template(root: list) -> dict:
    """What the wrapper says of its host: {"fixed": paths, "menus": paths, "root": path or "",
    "kept": paths of elements that hold most of the variable text, though their names tell to drop them}."""
    found: list[tuple[str, list, list, bool, int, tuple[str, ...]]] = []

    def walk(node: list, path: str, bad: bool, rank: int, hinted: tuple[str, ...]) -> tuple[int, int]:
        moving, linked = node[MOVING], node[LINKED]
        at = len(found)
        for label, below in node[BELOW].items():
            own_bad, own_rank = _label_facts(label)
            facts = (bad or own_bad == BY_KIND, max(rank, own_rank), (*hinted, f"{path}/{label}") if own_bad == BY_HINT else hinted)
            found.append((f"{path}/{label}", below, node, *facts))
            m, k = walk(below, f"{path}/{label}", *facts)
            moving, linked = moving + m, linked + k
        sums[path] = (moving, linked, sum(n[FIXED] for _, n, *_ in found[at:]) + node[FIXED])
        return moving, linked

    sums: dict[str, tuple[int, int, int]] = {}
    walk(root, "", False, 0, ())
    moving, _, fixed = sums[""]
    told = root[PAGES] >= LEAST_PAGES and moving >= VARIABLE * (moving + fixed)
    kept = {h[-1] for p, _, _, bad, _, h in found
            if root[PAGES] >= LEAST_PAGES and moving and not bad and h and p == h[-1] and sums[p][0] >= MAJORITY * moving}
    found = [(p, n, up, bad or not kept.issuperset(h), rank) for p, n, up, bad, rank, h in found]
    out = {"fixed": [], "menus": [], "root": "", "kept": sorted(kept)}
    for path, node, parent, bad, rank in found:
        if bad:
            continue
        same = node[TEXT] not in (None, SLOT) and node[PAGES] >= max(LEAST_PAGES, parent[PAGES] / 2)
        if told and same and not rank:
            out["fixed"].append(path)
        m, k, f = sums[path]
        if not rank and node[BELOW] and k >= LINKS * max(1, m + f):
            out["menus"].append(path)
    # descend to the node that holds most of the variable text outside dropped regions and menus
    weight = {p: sums[p][0] for p, _, _, bad, _ in found if not bad and not any(p == x or p.startswith(f"{x}/") for x in out["menus"])}
    here = root
    path = ""
    total = sum(w for p, w in weight.items() if p.count("/") == 1) + root[MOVING]
    while total and here[BELOW]:
        label, w = max(((k, weight.get(f"{path}/{k}", 0)) for k in here[BELOW]), key=lambda x: x[1])
        if w < MAJORITY * total or not here[BELOW][label][BELOW] and here[BELOW][label][REPEATED]:
            break
        if not here[BELOW][label][BELOW]:
            break
        path, here = f"{path}/{label}", here[BELOW][label]
    out["root"] = path
    # equal titles are part of the articles they head
    out["fixed"] = [p for p in out["fixed"] if not (path and p.startswith(f"{path}/") and re.split("[ [/]", p.rpartition("/")[2])[0] in HEADINGS)]
    return out


def main_text(page: str | None, said: dict | None) -> str:
    """The page's article blocks, one per line."""
    kept = set(said["kept"]) if said else set()
    found = [b for b in blocks(page) if b[3] >= 0 and kept.issuperset(b[4])]
    fixed, menus = (set(said["fixed"]), said["menus"]) if said else ((), ())
    found = [b for b in found if b[3] or b[0] not in fixed]
    # the article element, if it is most of what is ranked, else all below the outermost ranked elements, if that is most
    ranked, article = [b for b in found if b[3]], [b for b in found if b[3] == 3]
    if article and 2 * _size(article) >= _size(ranked):
        found = article
    else:
        found = [b for b in found if not any(b[0] == m or b[0].startswith(f"{m}/") for m in menus)]
        if ranked and 2 * _size(ranked) > _size(found):
            found = ranked
        elif said:
            below = [b for b in found if b[0] == said["root"] or b[0].startswith(f"{said['root']}/")]
            found = below or found
    return "\n".join(b[1] for b in found)


def _size(found: list[tuple[str, str, int, int, tuple[str, ...]]]) -> int:
    return sum(len(b[1]) for b in found)


def _page_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}

    def emit() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([json.dumps(w) for w in held.values()], pa.string())],
                                          names=["host", "wrapper"])
        held.clear()
        return rows

    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = page_wrapper(blocks(page))
            held[host] = align(held[host], own) if host in held else own
            if len(held) > HELD_HOSTS:
                yield emit()
    yield emit()


def _folder(keys: int, last: bool) -> Callable:
    """Streams rows sorted by their first ``keys`` columns and aligns the wrappers of equal keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, done = None, None, []
        rows = (r for b in batches for r in zip(*[b.column(i).to_pylist() for i in range(keys + 1)], strict=True))
        for *own, text in rows:
            node = json.loads(text)
            if own == key:
                held = align(held, node)
                continue
            if key is not None:
                done.append((key[0], held))
                if len(done) >= 500:
                    yield _folded(done, last)
                    done = []
            key, held = own, node
        if key is not None:
            done.append((key[0], held))
        yield _folded(done, last)

    return run


def _folded(done: list, last: bool) -> pa.RecordBatch:
    cols = [pa.array([h for h, _ in done], pa.string()), pa.array([json.dumps(w) for _, w in done], pa.string())]
    if last:
        cols += [pa.array([expression(w) for _, w in done], pa.string()), pa.array([json.dumps(template(w)) for _, w in done], pa.string()),
                 pa.array([w[PAGES] for _, w in done], pa.int64())]
    return pa.RecordBatch.from_arrays(cols, names=["host", "wrapper", "expression", "template", "n_pages"][:len(cols)])


def with_host(pages: DataFrame) -> DataFrame:
    host = ascii_lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:/?#]*://([^/?#]*)", 1))
    return pages.select("page_id", "url", host.alias("host"), "html")


def host_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, expression, template, n_pages) per host of ``pages`` (page_id, url, html)."""
    own = with_host(pages).select("host", "html").mapInArrow(_page_wrappers, "host string, wrapper string")
    # of a host, one row per task: a salt spreads them before the last fold
    own = store(own, "wrappers-tasks").withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    some = own.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper").select("host", "salt", "wrapper")
    some = store(some.mapInArrow(_folder(2, False), "host string, wrapper string"), "wrappers-salted")
    every = some.repartition("host").sortWithinPartitions("host", "wrapper")
    return store(every.mapInArrow(_folder(1, True), "host string, wrapper string, expression string, template string, n_pages long"), "wrappers")


def _extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, dict] = {}
    for batch in batches:
        for lo in range(0, len(batch), 500):
            part = batch.slice(lo, 500)
            texts = []
            for page, said in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                if said is not None and said not in known:
                    if len(known) >= HELD_HOSTS:
                        known.clear()
                    known[said] = json.loads(said)
                texts.append(main_text(page, known.get(said)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    known = host_wrappers(pages).select("host", "template")
    rows = with_host(pages).join(broadcast_if_small(known, 2_000), "host", "left")
    kinds = f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars long"
    return rows.select("page_id", "url", "html", "template").mapInArrow(_extractor, kinds)


def op2(spark, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
