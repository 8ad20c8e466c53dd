"""Main text of web pages through union-free wrappers inferred per host.

A page is a stream of tags, text slots and texts.  Tandem repeats in it are
folded into repeated groups; then the streams of a host are aligned one after
another: where one repeats a group that the other has once, both get the
repeated group, what only one of them has becomes an optional group, and
different texts at one place become a slot.  The result is a union-free regular
expression that every page of the host matches.  It tells which containers named
like boilerplate by a part of their name are only the host's layout: those in
which its one article lies; and which texts are the host's template: those that
no page has replaced by another.  Each page is then read slot by slot, outside
menus, headers, footers, side bars, notices, adverts, forms, comments and the
like: inside its article, or all its clean slots if it has none; a page without
an article is read in such a container too, and without the template's texts.

Texts that the alignment compares are those of blocks outside articles and
boilerplate, if most pages of the host that have such an element have them
(``LEAST_PAGES`` at least, copies counted once); rarer ones are slots from the
start, as no expression has them as its template.  So texts add few streams.
Alignment starts from distinct folded streams, first within salts of a host and
then over the salts, so a host with a third of all pages is a few rows.

Defined results: null html is an empty page; a page without main text gives the
empty string; a page without an article that has only texts of the template keeps
them, and an article is never compared with others; a null or relative url belongs to the host ``''``; unclosed and
misplaced tags are tolerated; repeated rows are read one by one; a null
``page_id`` stays null; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import html as entities
import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.llm.common import stage

SALTS = 64
LONGEST_GROUP = 40
LEAST_PAGES = 3

# Kinds of HTML elements and the names pages give to boilerplate.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
NEVER_MAIN = frozenset(
    "nav header footer aside form script style noscript template iframe textarea select option "
    "button input svg canvas object embed video audio head title dialog menu xmp".split()
)
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments cookie cookies consent disclaimer discussion footer gdpr header masthead menu modal "
    "nav navbar navigation newsletter notice notices pagination popup popular promo promoted "
    "promotion reader-comments related replies respond share sharing sidebar social sponsor "
    "sponsored subscribe subscription tags toolbar widget".split()
)
MAIN_NAMES = frozenset(("main", "articlebody", "article-body"))

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[a-z][a-z-]*")
#: Before a part of a name: it tells of the page's layout, not of the element.
_STATE = frozenset("no has with without".split())


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("open" | "close" | "text", element key or name, text) in page order."""
    at, size = 0, len(page)
    while at < size:
        found = _MARKUP.search(page, at)
        if found is None:
            yield "text", "", page[at:]
            return
        if found.start() > at:
            yield "text", "", page[at : found.start()]
        at = found.end()
        name = found.group(2)
        if name is None:
            continue
        name = name.lower()
        if found.group(1):
            yield "close", name, ""
            continue
        yield "open", name + _names(found.group(3), name not in ("html", "body")), ""
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            stop = end.start() if end else size
            yield "text", "", page[at:stop]
            at = stop


def _names(attributes: str, partial: bool = True) -> str:
    """`` name name`` of the telling attributes that matter for judging a slot.

    Names that tell by a part only are marked with ``~``.
    """
    if "=" not in attributes:
        return ""
    words = {w for m in _NAMED.finditer(attributes) for w in _WORD.findall(m.group(1).lower())}
    telling = {w for w in words if w in BOILERPLATE or w in MAIN_NAMES}
    for word in words - telling if partial else ():
        pieces = word.split("-")
        telling |= {
            "~" + piece for n, piece in enumerate(pieces)
            if piece in BOILERPLATE and not _STATE & set(pieces[:n])
        }
    return "".join(f" {w}" for w in sorted(telling))


class Path:
    """The open elements while tags go by; tolerates unclosed ones."""

    def __init__(self):
        self.open: list[str] = []

    def enter(self, key: str) -> None:
        name = key.split(" ", 1)[0]
        if name in VOID:
            return
        if name in ENDS_PARAGRAPH:
            self._end("p", INLINE)
        elif name == "li":
            self._end("li", INLINE | {"p"})
        self.open.append(key)

    def _end(self, name: str, over: frozenset | set) -> None:
        """Close an open ``name`` if only elements of ``over`` lie inside it."""
        for n in range(len(self.open) - 1, -1, -1):
            own = self.open[n].split(" ", 1)[0]
            if own == name:
                del self.open[n:]
                return
            if own not in over:
                return

    def leave(self, name: str) -> None:
        for n in range(len(self.open) - 1, -1, -1):
            if self.open[n].split(" ", 1)[0] == name:
                del self.open[n:]
                return

    def slot(self) -> str:
        return "/".join(k for k in self.open if k not in INLINE)


def block_text(texts: list[str]) -> str:
    return " ".join(entities.unescape("".join(texts)).split())


def text_hash(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


@functools.lru_cache(100_000)
def comparable(slot: str) -> bool:
    """Whether texts there may be the host's template: not in articles, nor boilerplate by a whole name."""
    return not (in_article(slot) or boilerplate(slot, partial=False))


def read_items(page: str) -> tuple[list, str]:
    """Tags, text slots and ``=`` with the hash of a comparable block's text; a hash of what the page says.

    A block lies between tags that are not inline; it stands where its first text does.
    """
    items: list = []
    path, said = Path(), hashlib.blake2b(digest_size=8)
    block: list[str] = []
    place, at = "", 0

    def finish() -> None:
        if block:
            text = block_text(block)
            if text:
                items[at] = "=" + text_hash(text)
            block.clear()

    for kind, key, text in tokens(page):
        if kind == "text":
            if text.isspace():
                if block:
                    block.append(text)
                continue
            slot = path.slot()
            if not items or items[-1] != "#":
                items.append("#")
            if comparable(slot):
                if not block:
                    place, at = slot, len(items) - 1
                if slot == place:
                    block.append(text)
                said.update(text.encode("utf-8", "surrogatepass"))
            elif in_article(slot):
                said.update(text.encode("utf-8", "surrogatepass"))
            continue
        name = key.split(" ", 1)[0]
        if name not in INLINE and name not in RAW:
            finish()
        if kind == "close":
            items.append("/" + key)
            path.leave(name)
        else:
            items.append("<" + key)
            path.enter(key)
    finish()
    return items, said.hexdigest()


def texts_of(items: Iterable) -> Iterator[tuple[int, str, str]]:
    """(number of the item, slot, hash) of the texts among items."""
    path = Path()
    for at, item in enumerate(items):
        if item[0] == "=":
            yield at, path.slot(), item[1:]
        elif item[0] == "<":
            path.enter(item[1:])
        elif item[0] == "/":
            path.leave(item[1:])


def stream_of(items: list, shared: frozenset | set = frozenset()) -> list:
    """Items folded; texts that are not among the shared (slot, hash) are slots."""
    items = list(items)
    for at, *text in texts_of(items):
        if tuple(text) not in shared:
            items[at] = "#"
    return fold(items)


def stream(page: str, shared: frozenset | set = frozenset()) -> list:
    """Tags, text slots and shared texts of a page, folded."""
    return stream_of(read_items(page)[0], shared)


def fold(items: list) -> list:
    """Turn adjacent equal groups into ("+", group), short groups first."""
    size = 1
    while size <= min(LONGEST_GROUP, len(items)):
        out: list = []
        at, folded = 0, False
        while at < len(items):
            group = items[at : at + size]
            if size > 1 or isinstance(group[0], str):
                stop = at + size
                while items[stop : stop + size] == group:
                    stop += size
                if stop > at + size:
                    out.append(("+", tuple(group)))
                    at, folded = stop, True
                    continue
            if out and isinstance(items[at], tuple) and out[-1] == items[at]:
                at, folded = at + 1, True
                continue
            out.append(items[at])
            at += 1
        items = out
        size = 1 if folded and size > 1 else size + 1
    return items


def _repeat(items: list, group: tuple) -> list:
    """Let every occurrence of a group be the repeated group."""
    out: list = []
    at, size = 0, len(group)
    while at < len(items):
        if tuple(items[at : at + size]) == group:
            if not out or out[-1] != ("+", group):
                out.append(("+", group))
            at += size
        elif items[at] == ("+", group) and out and out[-1] == items[at]:
            at += 1
        else:
            out.append(items[at])
            at += 1
    return out


def _is_text(side: list) -> bool:
    """Whether a side has one text or slot only, optional or not."""
    if len(side) != 1:
        return False
    item = side[0]
    if isinstance(item, tuple):
        return item[0] == "?" and len(item[1]) == 1 and _is_text([item[1][0]])
    return item[0] in "#="


def align(a: list, b: list) -> list:
    """The union-free expression that generalises two."""
    if a == b:
        return a
    for _ in range(2):
        for own, other in ((a, b), (b, a)):
            for item in [i for i in own if isinstance(i, tuple) and i[0] == "+"]:
                other[:] = _repeat(list(other), item[1])
    bare_a = [i[1] if isinstance(i, tuple) and i[0] == "?" else i for i in a]
    bare_b = [i[1] if isinstance(i, tuple) and i[0] == "?" else i for i in b]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below, x = best[i], best[i + 1], bare_a[i]
        for j in range(m - 1, -1, -1):
            if x == bare_b[j]:
                row[j] = below[j + 1] + 1
            else:
                row[j] = below[j] if below[j] >= row[j + 1] else row[j + 1]
    out: list = []
    only_a: list = []
    only_b: list = []

    def close() -> None:
        if _is_text(only_a) and _is_text(only_b):  # different texts at one place: a slot
            optional = isinstance(only_a[0], tuple) or isinstance(only_b[0], tuple)
            out.append(("?", ("#",)) if optional else "#")
            only_a.clear(), only_b.clear()
            return
        for side in (only_a, only_b):
            run: list = []
            for item in side:
                if isinstance(item, tuple) and item[0] == "?":
                    if run:
                        out.append(("?", tuple(run)))
                        run = []
                    out.append(item)
                else:
                    run.append(item)
            if run:
                out.append(("?", tuple(run)))
            side.clear()

    i = j = 0
    while i < n and j < m:
        if bare_a[i] == bare_b[j]:
            close()
            optional = a[i] != bare_a[i] or b[j] != bare_b[j]
            out.append(("?", bare_a[i]) if optional else a[i])
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            only_a.append(a[i])
            i += 1
        else:
            only_b.append(b[j])
            j += 1
    only_a.extend(a[i:])
    only_b.extend(b[j:])
    close()
    return out


def infer(streams: Iterable[list]) -> list:
    wrapper: list | None = None
    for items in streams:
        wrapper = list(items) if wrapper is None else align(list(wrapper), list(items))
    return wrapper or []


def to_text(items: list) -> str:
    return json.dumps(items, ensure_ascii=False, separators=(",", ":"))


def from_text(text: str) -> list:
    def thaw(item):
        return item if isinstance(item, str) else (item[0], tuple(map(thaw, item[1])))

    return [thaw(i) for i in json.loads(text)]


def matches(items: list, page: str) -> bool:
    """Whether the tags and slots of a page form a word of the expression."""
    symbols: dict[str, str] = {}

    def letter(token: str) -> str:
        return symbols.setdefault(token, chr(0xE000 + len(symbols)))

    def pattern(items) -> str:
        return "".join(
            letter(i) if isinstance(i, str) else f"(?:{pattern(i[1])}){i[0]}" for i in items
        )

    plain = []
    for kind, key, text in tokens(page):
        if kind == "text":
            if not text.isspace() and (not plain or plain[-1] != "#"):
                plain.append("#")
        else:
            plain.append(("/" if kind == "close" else "<") + key)
    return re.fullmatch(pattern(items), "".join(map(letter, plain))) is not None


def boilerplate(slot: str, partial: bool = True) -> bool:
    for key in slot.split("/"):
        name, *words = key.split(" ")
        if name in NEVER_MAIN or any(w in BOILERPLATE or (partial and w[0] == "~") for w in words):
            return True
    return False


def _around(slot: str) -> bool:
    """Whether only elements around the article are boilerplate, by parts of names."""
    keys = slot.split("/")
    first = next((n for n in range(len(keys)) if in_article(keys[n])), len(keys))
    return first < len(keys) and not (
        boilerplate("/".join(keys[:first]), partial=False) or boilerplate("/".join(keys[first:]))
    )


#: How a slot is judged.
ARTICLE, ENCLOSED, LAID_OUT, CLEAN, NEVER = range(5)


def judge(slot: str, layout: frozenset[str]) -> int:
    if not boilerplate(slot):
        return ARTICLE if in_article(slot) else CLEAN
    if _around(slot):
        return ENCLOSED
    for around in () if in_article(slot) else layout:
        if slot == around or slot.startswith(around + "/") and not boilerplate(slot[len(around) + 1 :]):
            return LAID_OUT
    return NEVER


def in_article(slot: str) -> bool:
    return any(
        key.split(" ")[0] in ("article", "main") or MAIN_NAMES & set(key.split(" ")[1:])
        for key in slot.split("/")
    )


def _opened(items: Iterable, repeated: bool = False) -> Iterator[tuple[str, bool]]:
    """Tokens of an expression, and whether they lie in a repeated group."""
    for item in items:
        if isinstance(item, str):
            yield item, repeated
        else:
            yield from _opened(item[1], repeated or item[0] == "+")


def main_slots(wrapper: list) -> tuple[frozenset[str], frozenset[tuple[str, str]]]:
    """The containers that are the host's layout, and the (slot, hash) of its template's texts.

    Containers are paths, whatever their names tell by a part: these hold the host's
    only article; cards come as several articles, and where an article lies outside
    such containers, they are what their names tell.
    """
    path, articles = Path(), []
    template = frozenset((slot, text) for _, slot, text in texts_of(t for t, _ in _opened(wrapper)))
    for token, repeated in _opened(wrapper):
        if token[0] == "<":
            around = path.slot()
            path.enter(token[1:])
            if in_article(token[1:]) and not in_article(around):
                articles.append((around, token[1:], repeated))
        elif token[0] == "/":
            path.leave(token[1:])
    if len(articles) != 1 or articles[0][2]:
        return frozenset(), template
    around, key, _ = articles[0]
    laid_out = boilerplate(around) and _around(f"{around}/{key}")
    return frozenset((around,)) if laid_out else frozenset(), template


def main_text(page: str, layout: frozenset[str], template: frozenset[tuple[str, str]] = frozenset()) -> str:
    """Text of the main slots; blocks in page order, joined by one blank.

    They are the page's own article, or else its clean slots; an article that is
    enclosed by a name telling by a part goes before less clean text, and so does,
    where there is no article, what lies in the host's layout containers.  Outside
    articles texts of the template are left out, unless the page has no others.
    """
    path = Path()
    known: dict[str, int] = {}
    blocks: tuple[list[str], ...] = ([], [], [], [])
    shared: tuple[list[str], ...] = ([], [], [], [])  # with the template's texts
    block: tuple[list[str], ...] = ([], [], [], [])
    places = [""] * 4

    def finish() -> None:
        for kind, own in enumerate(block):
            if own:
                text = block_text(own)
                if text:
                    shared[kind].append(text)
                    outside = template and kind in (LAID_OUT, CLEAN)
                    if not (outside and (places[kind], text_hash(text)) in template):
                        blocks[kind].append(text)
                own.clear()

    for kind, key, text in tokens(page):
        if kind == "text":
            slot = path.slot()
            if slot not in known:
                known[slot] = judge(slot, layout)
            own = known[slot]
            if own != NEVER:
                if text.isspace() and not block[own]:
                    continue
                if not block[own]:
                    places[own] = slot
                block[own].append(text)
            continue
        name = key.split(" ", 1)[0]
        if name not in INLINE and name not in RAW:
            finish()
        if kind == "open":
            path.enter(key)
        else:
            path.leave(key)
    finish()
    if not any(blocks):
        blocks = shared
    inside, enclosed, laid_out, clean = map(" ".join, blocks)
    enclosed = enclosed or laid_out
    return inside or (enclosed if len(enclosed) > len(clean) else clean)


STREAM = "host string, stream string, said string"


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folded streams; items of pages with texts to compare, with a hash of what these say."""
    for batch in batches:
        streams, says = [], []
        for page in batch.column(1):
            items, said = read_items(page.as_py())
            compared = any(i[0] == "=" for i in items)
            streams.append(to_text(items if compared else fold(items)))
            says.append(said if compared else None)
        yield pa.record_batch(
            [batch.column(0), pa.array(streams, pa.string()), pa.array(says, pa.string())],
            names=["host", "stream", "said"],
        )


def _texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each slot with texts of a page, and each of these texts, once."""
    for batch in batches:
        rows = []
        for host, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            texts = {(slot, text) for _, slot, text in texts_of(from_text(items))}
            rows += [(host, slot, None) for slot in {slot for slot, _ in texts}]
            rows += [(host, slot, text) for slot, text in texts]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.record_batch([pa.array(c, pa.string()) for c in columns], names=["host", "slot", "text"])


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        folded = []
        for items, shared in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            shared = {(s["slot"], s["text"]) for s in shared or ()}
            folded.append(to_text(stream_of(from_text(items), shared)))
        yield pa.record_batch([batch.column(0), pa.array(folded, pa.string())], names=["host", "stream"])


def shared_texts(compared: DataFrame) -> DataFrame:
    """(host, shared): texts that most pages have in a slot, of rows (host, stream) with items."""
    counts = stage(
        compared.select("host", "stream")
        .mapInArrow(_texts_of, "host string, slot string, text string")
        .groupBy("host", "slot", "text")
        .agg(F.count("*").alias("pages")),
        "texts",
    )
    slots = counts.filter("text is null").select("host", "slot", F.col("pages").alias("of"))
    return (
        counts.filter(F.col("text").isNotNull() & (F.col("pages") >= LEAST_PAGES))
        .join(slots, ["host", "slot"])
        .filter(F.col("pages") * 2 > F.col("of"))
        .groupBy("host")
        .agg(F.collect_list(F.struct("slot", "text")).alias("shared"))
    )


def _inferred(rows: pd.DataFrame) -> pd.DataFrame:
    ordered = sorted(rows["stream"], key=lambda s: (len(s), s))
    return pd.DataFrame(
        {"host": [rows["host"].iloc[0]], "stream": [to_text(infer(map(from_text, ordered)))]}
    )


def infer_wrappers(pages: DataFrame, salts: int = SALTS) -> DataFrame:
    """(host, stream): the wrapper of every host, from rows (host, html)."""
    streams = stage(pages.select("host", "html").mapInArrow(_streams, STREAM).distinct(), "streams")
    compared = streams.filter("said is not null")
    shared = stage(shared_texts(compared), "shared")
    folded = (
        compared.join(shared, "host", "left")
        .select("host", "stream", "shared")
        .mapInArrow(_folded, "host string, stream string")
    )
    distinct = streams.filter("said is null").select("host", "stream").union(folded).distinct()
    salted = (
        distinct.withColumn("salt", F.pmod(F.xxhash64("stream"), F.lit(salts)))
        .groupBy("host", "salt")
        .applyInPandas(_inferred, "host string, stream string")
    )
    return salted.groupBy("host").applyInPandas(_inferred, "host string, stream string")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    judged: dict[str, tuple] = {}
    for batch in batches:
        texts = []
        for page, wrapper in zip(batch.column(2), batch.column(3), strict=True):
            wrapper = wrapper.as_py()
            if wrapper not in judged:
                judged[wrapper] = main_slots(from_text(wrapper))
            texts.append(main_text(page.as_py(), *judged[wrapper]))
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    host = F.lower(F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    given = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("host", F.coalesce(host, F.lit("")))
    # written first: the join then knows its size and broadcasts only if it is small
    wrappers = stage(infer_wrappers(given), "wrappers")
    return (
        given.join(wrappers, "host")
        .select("page_id", "url", "html", "stream")
        .mapInArrow(_texts, "page_id long, url string, text string, n_chars long")
    )
