"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

A page's tokens (tags, texts) are read as nested runs. Pages of a host are aligned one after another into a wrapper: what
matches stays, texts that differ become text slots, what only one side has becomes optional, and equal neighbours become a
repeated group, whose rounds are aligned with each other in the same way. Where a run of children grows without end it becomes
a repeated group of optional parts. There is no other alternative in it, so the expression is union-free.

The wrapper tells how a host builds its pages: for each part whether its texts are the same on all pages (the site's own)
or slots, how much text the slots hold, and how much of it is links. On every page the wrapper says where the main parts lie.
Names in the markup (``<article>``, role, class, id) are evidence for it: named parts whose slots hold text that is not
mostly links, over all of the host's pages; lists of teasers and named parts that the site repeats are none. Where the
wrapper has no such part it is the one below which most slot text outside links is found. A page's blocks inside the main parts
are its text, without what tags, roles, classes or ids mark as menu, header, footer, sidebar, notice, advert, form or
comment. Texts that are the same on all of a host's pages go as well: blocks whose own text is that of such a part, not
others that lie below the same labels. Inside a named part that takes more proof: the part is on every page, and the host
has at least ``PROVEN_PAGES`` pages whose texts differ, copies counted once. A page that the wrapper does not match is
read by its own markup.

Wrappers are built inside partitions first, a host's partial wrappers are then merged in two rounds, so a host with a third of
all pages is no single group. A wrapper's size is bounded (``MOST_PARTS`` a level, ``MOST_DEPTH`` levels).

A null or empty page has no text. Pages without a host in their url share a wrapper. Rows that repeat give equal rows. An
empty table gives no rows. Columns other than the three named are not read.
"""

from __future__ import annotations

import html
import json
import math
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import save

MOST_PARTS = 48
MOST_DEPTH = 24
#: Hosts whose wrappers a task holds; beyond this it hands them on and starts anew.
HELD_HOSTS = 2000
#: Different pages that show a text inside a named article to be the site's own, and links' share of a list of them.
PROVEN_PAGES = 20
MOSTLY_LINKS = 0.8

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(script|style|noscript|template|svg|iframe|textarea|select|object|canvas|math)\b"
    r"""(?:[^>"']|"[^"]*"|'[^']*')*+>.*?(?:</\1\s*>|\Z)|</?[a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*+>|</?[a-zA-Z][^>]*>|[^<]+|<""",
    re.DOTALL | re.IGNORECASE,
)
NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
MARK = re.compile(r"""(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.IGNORECASE)
SPACE = re.compile(r"\s+")

# Elements by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("script style noscript template svg iframe textarea select object canvas math head title".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
AWAY = set("nav footer aside form button dialog menu header".split())
CLOSES_P = BLOCKS - {"caption", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt", "legend", "summary", "body", "html"}
CLOSED_BY = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table"}}
AWAY_WORDS = set(
    "ad ads advert adverts advertisement advertising advertorial adsense adslot banner banners sponsor sponsored sponsors promo promos promotion "
    "adbox adunit adsbygoogle nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars rail widget widgets footer header masthead topbar "
    "notice notices alert cookie cookies consent gdpr banner popup modal overlay newsletter subscribe subscription signup login paywall disclaimer "
    "comment comments commentlist reply replies respond disqus discussion share sharing social related recommended recommendations "
    "toolbar search skip".split()
)
AWAY_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
MAIN_WORDS = set("article articlebody post entry story maincontent".split())


class Part:
    """A node of a page or a wrapper."""

    __slots__ = ("label", "children", "text", "same", "slot_chars", "link_chars", "seen", "optional", "repeated", "pages")

    def __init__(self, label: str):
        self.label = label
        self.children: list[Part] = []
        self.text: str | None = None  # own texts, as digests; not kept once they differ
        self.same = True  # whether the own texts were the same on all pages
        self.slot_chars = self.link_chars = 0
        self.seen = 1
        self.optional = self.repeated = False
        self.pages: set[int] = set()  # of the whole page: smallest digests of the pages' texts, ``PROVEN_PAGES`` at most

    def packed(self) -> list:
        flags = self.optional + 2 * self.repeated + 4 * self.same
        return [self.label, flags, self.text, self.slot_chars, self.link_chars, self.seen, [c.packed() for c in self.children], sorted(self.pages)]

    @staticmethod
    def unpacked(x: list) -> Part:
        part = Part(x[0])
        part.optional, part.repeated, part.same = bool(x[1] & 1), bool(x[1] & 2), bool(x[1] & 4)
        part.text, part.slot_chars, part.link_chars, part.seen = x[2:6]
        part.children = [Part.unpacked(c) for c in x[6]]
        part.pages = set(x[7])
        return part

    def expression(self) -> str:
        """The part as a union-free expression."""
        inside = "".join(c.expression() for c in self.children)
        text = "" if self.text is None and self.same else ("text" if self.same else "#text")
        whole = f"<{self.label}>{text}{inside}</>"
        if self.repeated:
            whole = f"({whole})+"
        return f"({whole})?" if self.optional else whole


def label_of(tag: str, attributes: str, in_article: bool) -> tuple[str, bool, bool]:
    """A tag's label, whether its marks say that it is no main text, and whether they say it is hidden.

    An article's own header holds its title and stays.
    """
    name = tag
    away = tag in AWAY and not (in_article and tag == "header")
    hidden = False
    main = tag in ("article", "main")
    for m in MARK.finditer(attributes):
        kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if kind == "hidden" or kind == "aria-hidden" and value == "true":
            hidden = True
        elif kind == "style":
            hidden = hidden or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
        elif kind == "role":
            away = away or value in AWAY_ROLES
            main = main or value in ("main", "article")
        elif kind == "itemprop":
            main = main or value == "articlebody"
        elif value:
            words = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", m[2] or m[3] or m[4] or "").lower())
            if kind == "class":
                name += "." + ".".join(sorted(value.split())[:3])
            if in_article or not MAIN_WORDS.isdisjoint(words):
                words = [w for w in words if w != "header"]
            away = away or not AWAY_WORDS.isdisjoint(words)
            main = main or not MAIN_WORDS.isdisjoint(["".join(words), *words]) or words[:2] == ["main", "content"]
    return name + ("!" if away else "*" if main else ""), away, hidden


class Block:
    """A page's block of text: where it lies, and its pieces."""

    __slots__ = ("path", "pieces", "out")

    def __init__(self, path: tuple, out: bool):
        self.path, self.pieces, self.out = path, [], out


def read(page: str) -> tuple[Part, list[Block]]:
    """A page as nested parts, and its blocks in order. Markup errors are mended as browsers do, roughly."""
    root = Part("page")
    # Open elements: tag, part, whether it or one around it is no main text, whether inside a link, whether inside a
    # named article, place of the nearest block.
    stack: list[tuple[str, Part, bool, bool, bool, int]] = [("", root, False, False, False, 0)]
    paths: list[tuple] = [(root,)]  # of the open elements
    blocks: list[Block] = []
    block: Block | None = None

    def close_to(depth: int) -> None:
        nonlocal block
        if any(t[0] in BLOCKS for t in stack[depth:]):
            block = None
        del stack[depth:], paths[depth:]

    for m in TOKEN.finditer(page):
        token = m[0]
        if token[0] != "<" or token == "<":
            _, _, out, link, _, holder = stack[-1]
            if block is None:
                if token.isspace():
                    continue
                block = Block(paths[holder], stack[holder][2])
                blocks.append(block)
            block.pieces.append((token, link, out))
            continue
        name = NAME.match(token)
        if m[1] or not name:  # a script and the like with all it holds, a comment, a declaration
            continue
        tag = name[1].lower()
        if token[1] == "/":
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close_to(depth)
                    break
                if stack[depth][0] in ("table", "article", "body") and tag not in ("article", "body", "html", "main", "section", "div", "table"):
                    break  # a stray end tag does not end what is around it
            if tag in BLOCKS:
                block = None
            continue
        if tag in VOID:
            if tag == "hr":
                block = None
            elif tag == "br" and block is not None:
                block.pieces.append((" ", False, False))
            continue
        if tag in BLOCKS and any(s[0] == "head" for s in stack[:4]):
            close_to(next(k for k, s in enumerate(stack) if s[0] == "head"))
        if tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    close_to(depth)
                    break
                if stack[depth][0] in BLOCKS:
                    break
        if tag in CLOSED_BY:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in CLOSED_BY[tag]:
                    close_to(depth)
                    if tag != "tr":
                        break
                elif stack[depth][0] in SCOPE.get(tag, ()):
                    break
        label, away, hidden = label_of(tag, token[name.end() :], stack[-1][4])
        if tag in BLOCKS:
            block = None
        _, parent, around_out, around_link, named, holder = stack[-1]
        part, path = parent, paths[-1]
        # An article is a part however deep it lies.
        if len(path) < MOST_DEPTH or label.endswith("*") and not named:
            part = Part(label)
            parent.children.append(part)
            path = (*path, part)
        if not token.endswith("/>") or tag in BLOCKS:
            out = around_out or away or hidden or tag in SKIPPED
            stack.append((tag, part, out, around_link or tag == "a", named or label.endswith("*"), len(stack) if tag in BLOCKS else holder))
            paths.append(path)
    return root, blocks


def text_of(block: Block, out_too: bool = False) -> str:
    """A block's text: references decoded, white space as one space."""
    kept = "".join(t for t, _, out in block.pieces if out_too or not out)
    return SPACE.sub(" ", html.unescape(kept)).strip()


def _digest(text: str) -> str:
    return f"{zlib.crc32(text.encode('utf-8', 'surrogatepass')):08x}"


def skeleton(root: Part, blocks: list[Block]) -> Part:
    """A page's parts with the amounts of their texts, equal neighbours folded into repeated parts."""
    whole = 0
    for block in blocks:
        part = block.path[-1]
        text = text_of(block, True)
        if not block.out:
            whole = zlib.crc32(text.encode("utf-8", "surrogatepass"), whole)
        linked = sum(len(t) for t, link, _ in block.pieces if link)
        part.text = _digest(text) if part.text is None else f"{part.text},{_digest(text)}"
        part.slot_chars += len(text)
        part.link_chars += min(linked, len(text))
    root.pages = {whole}
    return _folded(root)


def _folded(part: Part) -> Part:
    folded: list[Part] = []
    for child in part.children:
        child = _folded(child)
        if folded and folded[-1].label == child.label:
            folded[-1] = align(folded[-1], child, one_page=True)
            folded[-1].repeated = True
        else:
            folded.append(child)
    part.children = _bounded(folded, one_page=True)
    return part


def _bounded(children: list[Part], one_page: bool = False) -> list[Part]:
    """Too long a run of children as a repeated group of optional parts, one for each label."""
    if len(children) <= MOST_PARTS:
        return children
    by_label: dict[str, Part] = {}
    for child in children:
        old = by_label.get(child.label)
        by_label[child.label] = align(old, child, one_page) if old else child
    for child in by_label.values():
        child.optional = child.repeated = True
    most = sorted(by_label.values(), key=lambda c: -c.slot_chars)[:MOST_PARTS]
    return sorted(most, key=lambda c: c.label)


def align(a: Part, b: Part, one_page: bool = False) -> Part:
    """The wrapper of two parts with one label; ``a`` is changed into it. Parts of one page are rounds of a group."""
    if one_page:
        if b.text is not None:
            a.text = b.text if a.text is None else f"{a.text},{b.text}"
        a.same = a.same and b.same
    else:
        a.same = a.same and b.same and a.text == b.text
        a.seen += b.seen
        a.pages = set(sorted(a.pages | b.pages)[:PROVEN_PAGES])
    if not a.same:
        a.text = "#"
    a.slot_chars += b.slot_chars
    a.link_chars += b.link_chars
    a.optional, a.repeated = a.optional or b.optional, a.repeated or b.repeated
    x, y = a.children, b.children
    if [c.label for c in x] == [c.label for c in y]:
        a.children = [align(c, d, one_page) for c, d in zip(x, y)]
        return a
    # Longest common run of labels; what lies between is optional.
    n, m = len(x), len(y)
    long = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            long[i][j] = long[i + 1][j + 1] + 1 if x[i].label == y[j].label else max(long[i + 1][j], long[i][j + 1])
    i = j = 0
    merged: list[Part] = []

    def add(part: Part) -> None:
        part.optional = True
        if merged and merged[-1].label == part.label:
            merged[-1] = align(merged[-1], part, True)
            merged[-1].repeated = True
        else:
            merged.append(part)

    while i < n or j < m:
        if i < n and j < m and x[i].label == y[j].label:
            merged.append(align(x[i], y[j], one_page))
            i, j = i + 1, j + 1
        elif j == m or i < n and long[i + 1][j] >= long[i][j + 1]:
            add(x[i])
            i += 1
        else:
            add(y[j])
            j += 1
    a.children = _bounded(merged, True)
    return a


def rules(wrapper: Part) -> dict:
    """What a wrapper says about its host's pages, by paths of labels: its named main parts, other named parts, the main part of pages
    that hold none of the former, and the site's own texts by path and digest."""
    proven = len(wrapper.pages) >= PROVEN_PAGES

    def is_own(part: Part, named: bool) -> bool:
        if part.text is None or not part.same:
            return False
        return proven and part.seen == wrapper.seen and not (part.optional or part.repeated) if named else part.seen >= 3

    def skipped(part: Part) -> bool:
        return part.label.endswith("!") or part.label.split(".")[0] in SKIPPED

    own: list[tuple] = []
    articles: dict[tuple, list[float]] = {}  # slot text of the outermost named parts, and what of it is links

    def walk(part: Part, path: tuple, article: tuple | None) -> tuple[float, tuple]:
        """Slot text outside links below a part, and the deepest path that still holds most of it."""
        if skipped(part):
            return 0.0, path
        path = (*path, part.label)
        if article is None and part.label.endswith("*"):
            article = path
        constant = is_own(part, article is not None)
        if constant:
            own.extend((path, text) for text in part.text.split(","))
        elif article:
            sums = articles.setdefault(article, [0.0, 0.0])
            sums[0] += part.slot_chars
            sums[1] += part.link_chars
        weight = 0.0 if constant else float(part.slot_chars - part.link_chars)
        found = [walk(c, path, article) for c in part.children]
        weight += sum(w for w, _ in found)
        best = max(zip(found, part.children), key=lambda x: x[0][0], default=None)
        if best and weight and best[0][0] >= 0.8 * weight and not _is_text_block(best[1].label):
            return weight, best[0][1]
        return weight, path

    weight, main = walk(wrapper, (), None)
    heaviest = max(articles, key=lambda a: articles[a][0] - articles[a][1], default=None)
    named = [a for a, (slots, links) in articles.items() if a == heaviest or slots and links <= MOSTLY_LINKS * slots]
    other = [a for a in articles if a not in named]
    return {"named": [list(a) for a in named], "other": [list(a) for a in other], "main": list(main), "own": [[list(p), text] for p, text in own] if weight else []}


def _is_text_block(label: str) -> bool:
    return re.split(r"[.!*]", label)[0] in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "td", "th", "dd", "dt", "a", "b", "i", "em", "span", "strong")


def main_text(page: str | None, known: dict | None) -> str:
    """A page's main text under its host's rules; without any, by its own markup."""
    if not page:
        return ""
    root, blocks = read(page)
    usable = [b for b in blocks if not b.out]
    marked = [b for b in usable if any(p.label.endswith("*") for p in b.path)] or usable
    texts = [text_of(b) for b in (_main_blocks(usable, known) if known else marked) or marked]
    return "\n\n".join(t for t in texts if t)


def _main_blocks(usable: list[Block], known: dict) -> list[Block]:
    """Blocks that lie in the wrapper's main parts and are not the site's own; none if the page is not like that."""
    own = {(tuple(p), text) for p, text in known["own"]}
    placed = [(b, tuple(p.label for p in b.path)) for b in usable]
    slots = [(b, p) for b, p in placed if (p, _digest(text_of(b, True))) not in own]
    named = {tuple(p) for p in known["named"]}
    article = [(b, next((p[:k] for k in range(1, len(p) + 1) if p[k - 1].endswith("*")), None)) for b, p in slots]
    inside = [b for b, a in article if a in named]
    other = {tuple(p) for p in known["other"]}
    if inside or any(a and a not in other for _, a in article):
        return inside
    main = tuple(known["main"])
    rest = [(b, p) for (b, p), (_, a) in zip(slots, article) if not a]
    return [b for b, p in rest if p[: len(main)] == main] or [b for b, _ in rest]


def _host(url: str = "url"):
    host = F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.coalesce(host, F.lit(""))


def _merge(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Wrappers of each group, aligned in a fixed order."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.column("wrapper").to_pylist())
        whole = Part.unpacked(json.loads(rows[0]))
        for row in rows[1:]:
            whole = align(whole, Part.unpacked(json.loads(row)))
        return pa.table({"host": table.column("host").slice(0, 1), "wrapper": [json.dumps(whole.packed(), separators=(",", ":"))]})

    return parts.groupBy(*keys).applyInArrow(run, "host string, wrapper string")


def host_wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """Rows ``(host, wrapper)``: a wrapper for each host, as nested JSON."""
    rows = pages.select(_host(url).alias("host"), F.col(page).alias("html")).filter("html is not null and html <> ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Part] = {}

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pydict({
                "host": pa.array(list(held), pa.string()),
                "wrapper": pa.array([json.dumps(w.packed(), separators=(",", ":")) for w in held.values()], pa.string()),
            })
            held.clear()
            return made

        for batch in batches:
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = skeleton(*read(text))
                held[host] = align(held[host], own) if host in held else own
                if len(held) > HELD_HOSTS:
                    yield out()
        yield out()

    parts = rows.mapInArrow(run, "host string, wrapper string").withColumn("part", F.spark_partition_id())
    parts = save(parts, "partial-wrappers")
    groups = max(1, math.isqrt(parts.agg(F.max("part")).first()[0] or 0))
    some = _merge(parts.withColumn("part", F.col("part") % groups), ["host", "part"])
    return _merge(some, ["host"])


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Rows ``(key, url, text, n_chars)``, one for each page."""

    def ruled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [json.dumps(rules(Part.unpacked(json.loads(w)))) for w in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"host": batch.column(0), "rules": pa.array(found, pa.string())})

    known = save(host_wrappers(pages, url, page).mapInArrow(ruled, "host string, rules string"), "wrapper-rules")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("html"), _host(url).alias("host"))
    kind = rows.schema["key"].dataType.simpleString()
    met = rows.join(known, "host", "left").select("key", "url", "html", "rules")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for own, rule in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if rule is not None and rule not in parsed:
                    parsed = {} if len(parsed) > HELD_HOSTS else parsed
                    parsed[rule] = json.loads(rule)
                texts.append(main_text(own, parsed.get(rule)))
            yield pa.RecordBatch.from_pydict({
                "key": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            })

    return met.mapInArrow(run, f"key {kind}, url string, text string, n_chars long").withColumnRenamed("key", key)
