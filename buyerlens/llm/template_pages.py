"""Main text of web pages by template deduction from equivalence classes of tokens.

A page is a list of blocks: runs of text between block-level tags, each under the path of its open
elements. Tokens are the block-level tags and the texts of blocks, told apart by their path. Over the
pages of a host a token has an occurrence vector: how often it stands on each page. Tokens that share
a vector form an equivalence class; vectors are compared by a fingerprint that adds up, so that the
pages of a host, however many, are summed where they are and no task sees them together.

A class is a candidate if it stands on enough of a host's pages (``MIN_SUPPORT``) and is either large or
as frequent on each of them. A class whose tokens stand more than once on each page is taken apart, since
the same text may stand in a header and a footer. A second pass over the pages keeps each page's row of
candidate tokens, as 32-bit numbers. These rows are validated, order first, then nesting twice, so that
what failed cannot stand around what is left:

* Order. A class's tokens follow the mean order of their places. Where they stand once a page, those
  outside the longest run in that order are out of order; where they repeat, the class has to go through
  all its tokens in turn, time after time.
* Nesting. What a class spans on a page lies in one gap between two tokens of the class around it. Of
  two that cross, the smaller one is blamed. The gaps that hold a class must be the same on each page.

Tokens and classes that pass on ``MIN_VALID`` of their pages make the template; `deduce` returns it with
the gap that holds each class. Texts of the template are dropped, but for those inside an article or main
element whose own element holds a slot as well: they are the wording around it. Texts in the gaps are the slots. If no slot is left on a page (its host's pages are copies of each other), all texts
count. Slots keep the main text unless their element says what they are: menus, headers, footers,
sidebars, forms, scripts, styles, notices, adverts, comments of readers. Of the slots that are left, those
inside the page's article (or main) element are its text, where it has one.

Texts are kept in page order; character references are decoded, white space inside a block becomes one
space, blocks are joined by one space. A null or empty page has an empty text. A page without a host is
of the host ``""``. Repeated rows count as pages of their own; ``page_id`` may be of any type. Unclosed
paragraphs, list items, table cells and the like end where the next begins; an end tag closes its
innermost open element, an end tag without one is ignored. Paths are hashed as they grow, so deep pages
take time by their length only."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from buyerlens.llm.words import mix
from buyerlens.session import checkpointed

#: A template token stands on this share of a host's pages, and the host has so many pages at least.
MIN_SUPPORT = 0.6
MIN_PAGES = 4
#: Tokens and classes that are in order and in their place on this share of their pages are valid.
MIN_VALID = 0.9
#: Tokens of a class that is not equally frequent on each page.
MIN_SIZE = 3
#: Candidate tokens of all hosts together that are broadcast; beyond that they are joined.
BROADCAST_TOKENS = 200_000

# ---- element names of public HTML: fixed values ----
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe textarea title".split())
FOREIGN = frozenset(("svg", "math"))
#: Elements whose content is no text of the page, but is parsed.
EMBEDDED = FOREIGN | frozenset("template object canvas select".split())
#: Start tags that close an open svg or math.
BREAKOUT = frozenset(
    "blockquote body center dd div dl dt h1 h2 h3 h4 h5 h6 head hr li menu nobr ol p pre ruby table ul".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr img".split())
#: Elements that the start tag of another ends, up to the element that holds both.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
}
#: Start tags that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre search section table ul".split())
NOT_MAIN = frozenset("nav header footer aside form menu dialog button fieldset head script style noscript template".split())
MAIN = frozenset(("article", "main"))
#: Elements that are not excluded by a word or a form, nor is what holds the page's article.
KEPT = MAIN | {"html", "body"}
#: Names in class, id and role attributes that are made of nothing but words for what is not main text.
_MARKED = re.compile(
    r"(?:^|\s)(?:(?:^|(?<=\s)|[_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|nav|navbar|navigation|menu|"
    r"breadcrumb|breadcrumbs|sidebar|side|footer|header|masthead|cookie|cookies|consent|notice|gdpr|popup|modal|overlay|newsletter|subscribe|"
    r"signup|login|share|sharing|social|related|recommended|comment|comments|commentlist|disqus|replies|reply|discussion|respond|widget|"
    r"toolbar|search|copyright|legal|contentinfo|complementary|alert|dialog)(?=$|[\s_-]))+(?=$|\s)", re.I)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)""", re.S)
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


class _Element:
    """An open element. ``hard``: it or one around it is no main text by its kind; ``soft``: it is a form or
    its own attributes say so; ``out``: neither it nor what is around it may be main text."""

    __slots__ = ("name", "parent", "path", "main", "hard", "soft", "out", "number")

    def __init__(self, name: str, parent: _Element | None, attributes: str):
        self.name, self.parent = name, parent
        self.path = blake2b(f"{parent.path if parent else ''}/{name}".encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
        self.main = name in MAIN or (parent is not None and parent.main)
        self.hard = name in EMBEDDED or (name in NOT_MAIN and name != "form") or (parent is not None and parent.hard)
        self.soft, self.out = name == "form", False
        if "=" not in attributes and "hidden" not in attributes.lower():
            return
        for key, value in _ATTRIBUTE.findall(attributes):
            value, key = value.strip("\"'"), key.lower()
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                self.hard = True
            elif key in ("class", "id", "role") and name not in KEPT and _MARKED.search(value):
                self.soft = True

    def around(self):
        element = self
        while element is not None:
            yield element
            element = element.parent


def _exclude(elements: list, holders: list) -> None:
    """Set ``out`` of all elements, given the elements that hold texts."""
    def settle():
        for e in elements:  # parents come first
            e.out = e.hard or e.soft or (e.parent is not None and e.parent.out)

    settle()
    bodies = [e for e in elements if e.name in MAIN and not e.hard]
    article = next((e for e in bodies if e.name == "main"), None)
    if article is None and bodies and all(e.out for e in bodies):
        article = bodies[0]
    if article is not None and article.out:
        for e in article.around():
            e.soft = False
        settle()
    texts = [e for e in holders if e is None or not e.hard]
    # a form, and then an element of whatever name, that holds all the page has is the page
    if texts and all(e is not None and e.out for e in texts):
        for e in elements:
            e.soft = e.soft and e.name != "form"
        settle()
    while texts and all(e is not None and e.out for e in texts):
        outermost = {id(x): x for x in ([a for a in e.around() if a.soft][-1] for e in texts)}
        if len(outermost) > 1:
            break
        next(iter(outermost.values())).soft = False
        settle()


def tokens(page: str | None) -> list[tuple[str, str, bool, bool, int]]:
    """``(token, text, main, excluded, element)`` in page order. Tags have an empty text; ``main`` holds inside an
    article or main element, ``excluded`` inside one that is not main text; elements are numbered, 0 is none."""
    out: list[tuple[str, str, _Element | None]] = []
    page = page or ""
    stack: list[_Element] = []
    elements: list[_Element] = []
    names: Counter = Counter()
    pieces: list[str] = []

    def path() -> str:
        return stack[-1].path if stack else ""

    def flush():
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            out.append((f"{path()}|{text}", text, stack[-1] if stack else None))

    def close(last: str):
        """Close open elements up to the innermost ``last``."""
        while True:
            name = stack.pop().name
            names[name] -= 1
            if name == last:
                return

    def make_room(name: str):
        """End what the start tag ``name`` ends."""
        if name in ENDS_P and stack and stack[-1].name == "p":
            close("p")
        ended, holders = ENDED_BY.get(name, ((), ()))
        if any(names[e] for e in ended):
            last = None
            for e in reversed(stack):
                if e.name in holders or e.name in MAIN:
                    break
                if e.name in ended:
                    last = e
            if last is not None:
                while stack[-1] is not last:
                    close(stack[-1].name)
                close(last.name)

    position = 0
    while position < len(page):
        tag = _TAG.search(page, position)
        if tag is None:
            pieces.append(page[position:])
            break
        pieces.append(page[position : tag.start()])
        position = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name in INLINE:
            continue
        flush()
        if tag[1]:
            if names[name]:
                close(name)
                out.append((f"{path()}</{name}>", "", None))
            continue
        if name in BREAKOUT and any(names[f] for f in FOREIGN) and not names["foreignobject"]:
            while any(names[f] for f in FOREIGN):
                close(stack[-1].name)
        make_room(name)
        out.append((f"{path()}<{name}>", "", None))
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>?", re.I).search(page, position)
            position = end.end() if end else len(page)
            continue
        if name in VOID or (tag[3] or "").endswith("/"):
            continue
        stack.append(_Element(name, stack[-1] if stack else None, tag[3] or ""))
        names[name] += 1
        elements.append(stack[-1])
        stack[-1].number = len(elements)
    flush()
    _exclude(elements, [e for _, text, e in out if text])
    return [(token, text, e is not None and e.main, e is not None and e.out, e.number if e else 0) for token, text, e in out]


def _hash(values: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(blake2b(v.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for v in values], dtype=np.uint64)


def _occurrences(batches):
    """Per batch, host and token: pages, least and most on a page, fingerprint of the vector, place sums."""
    for batch in batches:
        table: dict = {}
        texts: dict = {}
        for page_id, url, page in zip(*(batch.column(i).to_pylist() for i in range(3))):
            host, seen, place = host_of(url), {}, {}
            found = tokens(page)
            texts.update(zip(hashes := _hash([f[0] for f in found]).view(np.int64).tolist(), (bool(f[1]) for f in found)))
            for i, token in enumerate(hashes):
                seen[token] = seen.get(token, 0) + 1
                place.setdefault(token, i)
            salt = int(mix(_hash([f"{page_id}|{len(page or '')}"]))[0])
            for token, n in seen.items():
                row = table.setdefault((host, token), [0, n, n, 0, 0])
                row[0] += 1
                row[1], row[2] = min(row[1], n), max(row[2], n)
                row[3] = (row[3] + salt * n) & 0xFFFFFFFFFFFFFFFF
                row[4] += place[token]
        keys = list(table)
        rows = np.array(list(table.values()), dtype=object).reshape(-1, 5)
        yield pa.RecordBatch.from_pydict({
            "host": pa.array([h for h, _ in keys], pa.string()), "token": pa.array([t for _, t in keys], pa.int64()),
            "text": pa.array([texts[t] for _, t in keys], pa.bool_()), "pages": pa.array(rows[:, 0].tolist(), pa.int64()),
            "fewest": pa.array(rows[:, 1].tolist(), pa.int64()), "most": pa.array(rows[:, 2].tolist(), pa.int64()),
            "vector": pa.array(np.array(rows[:, 3].tolist(), dtype=np.uint64).view(np.int64)), "place": pa.array(rows[:, 4].tolist(), pa.int64()),
        })


def _host(pages: DataFrame):
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def classes(pages: DataFrame) -> DataFrame:
    """``host, cls, once, token, text, rank, pages``: candidate classes with their tokens in the order of their mean places.

    Fingerprints of vectors are sums modulo 2**64 and add up in any order. Classes hold tokens of most pages of
    their host, so a host has no more rows here than tokens on ``1 / MIN_SUPPORT`` pages."""
    source = pages.select(F.col("page_id").cast("string"), F.col("url").cast("string"), F.col("html").cast("string"))
    found = source.mapInArrow(
        _occurrences, "host string, token long, text boolean, pages long, fewest long, most long, vector long, place long")
    # a sum that may wrap around: halves are added apart and joined modulo 2**64
    low = F.sum(F.col("vector").bitwiseAND(F.lit(0xFFFFFFFF)))
    high = F.sum(F.shiftrightunsigned("vector", 32))
    summed = found.groupBy("host", "token", "text").agg(
        F.sum("pages").alias("pages"), F.min("fewest").alias("fewest"), F.max("most").alias("most"), low.alias("low"), high.alias("high"), F.sum("place").alias("place"))
    sizes = source.groupBy(_host(source).alias("host")).agg(F.count("*").alias("of"))
    often = summed.where(f"pages >= {MIN_PAGES}").join(sizes, "host").where(F.col("pages") >= MIN_SUPPORT * F.col("of"))
    carried = F.pmod(F.col("high") + F.shiftright("low", 32), F.lit(1 << 32))
    vector = F.shiftleft(carried, 32).bitwiseOR(F.col("low").bitwiseAND(F.lit(0xFFFFFFFF)))
    rigid = F.col("fewest") == F.col("most")
    cls = F.when(rigid & (F.col("most") > 1), F.xxhash64(vector, "token")).otherwise(vector)
    named = often.select("host", cls.alias("cls"), (F.col("most") == 1).alias("once"), rigid.alias("rigid"), "token", "text", "pages",
                         (F.col("place") / F.col("pages")).alias("place"))
    members = Window.partitionBy("host", "cls")
    sized = named.withColumn("size", F.count("*").over(members)).where(F.col("rigid") | (F.col("size") >= MIN_SIZE))
    rank = F.row_number().over(members.orderBy("place", "token")) - 1
    ranked = sized.select("host", "cls", "once", "token", "text", rank.cast("int").alias("rank"), "pages")
    return ranked.withColumn("at", F.row_number().over(Window.partitionBy("host").orderBy("cls", "rank")) - 1)


def in_order(found: list[int], frame: dict) -> tuple[list[int], set, list]:
    """Of a page's row of tokens: those out of order, the classes out of order, and the others by class.

    ``frame`` gives a token's class, rank, whether its class stands once a page, and the class's size."""
    places: dict = {}
    for i, token in enumerate(found):
        if token in frame:
            places.setdefault(frame[token][0], []).append((i, token))
    wrong, bad, good = [], set(), []
    for cls, mine in places.items():
        once, size = frame[mine[0][1]][2:]
        ranks = [frame[token][1] for _, token in mine]
        if once:
            kept = _rising(ranks)
            wrong += [token for k, (_, token) in enumerate(mine) if k not in kept]
            good.append((cls, [x for k, x in enumerate(mine) if k in kept], len(kept)))
        elif len(ranks) % size or any(r != k % size for k, r in enumerate(ranks)):
            bad.add(cls)
        else:
            good.append((cls, mine, size))
    return wrong, bad, good


def held_by(good: list) -> dict:
    """Per class of a page the gaps that hold it: the class around it and the token of it before; none if classes cross there."""
    crossing: set = set()
    while True:
        events = []
        for cls, mine, size in good:
            if cls not in crossing:
                events += [(i, cls, token, size, k % size == 0, k % size == size - 1) for k, (i, token) in enumerate(mine)]
        held, around, found = {}, [], set()  # around: open classes with the last token seen and their size
        for _, cls, token, size, first, last in sorted(events):
            if cls in found:
                continue
            if first:
                gap = around[-1][:2] if around else (0, 0)
                gaps = held.setdefault(cls, [])
                if not gaps or gaps[-1] != gap:
                    gaps.append(gap)
            else:
                at = next(k for k, open_ in enumerate(around) if open_[0] == cls)
                inside = around[at + 1 :]
                if any(open_[2] >= size for open_ in inside):
                    found.add(cls)
                    del around[at]
                    continue
                found.update(open_[0] for open_ in inside)
                del around[at:]
            if not last:
                around.append((cls, token, size))
        if not found:
            return held
        crossing |= found


def _rising(ranks: list[int]) -> set[int]:
    """Places of a longest rising run of ``ranks``."""
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for i, rank in enumerate(ranks):
        k = bisect_left(ends, rank)
        before.append(last[k - 1] if k else -1)
        ends[k:], last[k:] = [rank, *ends[k + 1 :]], [i, *last[k + 1 :]]
    out, i = set(), last[-1] if last else -1
    while i >= 0:
        out.add(i)
        i = before[i]
    return out


def _rows(batches):
    """Per page: the numbers of its candidate tokens, in page order."""
    for batch in batches:
        known: dict = {}
        out = []
        for i, (host, page) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if host not in known:
                known[host] = {r["token"]: r["at"] for r in batch.column(2)[i].as_py()}
            at = known[host]
            found = _hash([t[0] for t in tokens(page)]).view(np.int64).tolist()
            out.append(np.array([at[t] for t in found if t in at], dtype="<u4").tobytes())
        yield pa.RecordBatch.from_pydict({"host": batch.column(0), "row": pa.array(out, pa.binary())})


def _frame(rows: list[dict]) -> dict:
    sizes = Counter(r["cls"] for r in rows)
    return {r["at"]: (r["cls"], r["rank"], r["once"], sizes[r["cls"]]) for r in rows}


def _counted(marks):
    """Counts of ``marks`` of a page's row, per batch and host: kind, key, gaps."""
    def run(batches):
        for batch in batches:
            frames: dict = {}
            table: Counter = Counter()
            for i, (host, row) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if host not in frames:
                    frames[host] = _frame(batch.column(2)[i].as_py())
                table.update((host, *mark) for mark in marks(*in_order(np.frombuffer(row, "<u4").tolist(), frames[host])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in table], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int64(), pa.string()))]
                + [pa.array(list(table.values()), pa.int64())], names=["host", "kind", "key", "gaps", "n"])
    return run


def _disorder(wrong, bad, good):
    return [(0, token, "") for token in wrong] + [(1, cls, "") for cls in bad]


def _nesting(wrong, bad, good):
    return [(2, cls, ",".join(f"{parent}:{token}" for parent, token in gaps)) for cls, gaps in held_by(good).items()]


def _beside(rows: DataFrame, side: DataFrame, tokens_: int, how: str) -> DataFrame:
    return rows.join(F.broadcast(side) if tokens_ <= BROADCAST_TOKENS else side, "host", how)


def _marked(rows: DataFrame, candidates: DataFrame, marks) -> DataFrame:
    frames = candidates.groupBy("host").agg(F.collect_list(F.struct("at", "cls", "rank", "once")).alias("frame"))
    beside = _beside(rows, frames, candidates.limit(BROADCAST_TOKENS + 1).count(), "inner").select("host", "row", "frame")
    return beside.mapInArrow(_counted(marks), "host string, kind int, key long, gaps string, n long").groupBy(
        "host", "kind", "key", "gaps").agg(F.sum("n").alias("n"))


def deduce(pages: DataFrame) -> DataFrame:
    """``host, cls, token, text, rank, gaps``: the valid tokens of each host's template, in class order.

    ``gaps`` names what holds the class, ``class:token`` for each of its gaps: the class around and the number of its token
    before the gap; ``0:0`` is the page itself."""
    candidates = checkpointed(classes(pages))
    frames = candidates.groupBy("host").agg(F.collect_list(F.struct("token", "at")).alias("frame"))
    source = pages.select(_host(pages).alias("host"), F.col("html").cast("string").alias("html"))
    beside = _beside(source, frames, candidates.limit(BROADCAST_TOKENS + 1).count(), "inner").select("host", "html", "frame")
    rows = checkpointed(beside.mapInArrow(_rows, "host string, row binary"))
    disorder = checkpointed(_marked(rows, candidates, _disorder))
    tokens_ = disorder.where("kind = 0").select("host", F.col("key").alias("at"), F.col("n").alias("astray"))
    broken = disorder.where("kind = 1").select("host", F.col("key").alias("cls"), F.col("n").alias("broken"))
    most = (1 - MIN_VALID) * F.col("pages")
    valid = checkpointed(candidates.join(tokens_, ["host", "at"], "left").join(broken, ["host", "cls"], "left").where(
        (F.coalesce("astray", F.lit(0)) <= most) & (F.coalesce("broken", F.lit(0)) <= most)).select(candidates.columns))
    for _ in range(2):
        held = _marked(rows, valid, _nesting).groupBy("host", F.col("key").alias("cls")).agg(
            F.max("n").alias("held"), F.max_by("gaps", F.struct("n", "gaps")).alias("gaps"))
        nested = checkpointed(valid.drop("gaps").join(held, ["host", "cls"]).where(F.col("held") >= MIN_VALID * F.col("pages")).drop("held"))
        valid = nested
    return valid.select("host", "cls", "token", "text", "rank", "gaps")


def main_text(page: str | None, template: frozenset) -> str:
    """Text of the slots that a template leaves."""
    found = tokens(page)
    slots = [(token, text, main, element) for token, text, main, excluded, element in found if text and not excluded]
    if any(slot[2] for slot in slots):
        slots = [slot for slot in slots if slot[2]]
    if template and slots:
        filled = [h not in template for h in _hash([slot[0] for slot in slots]).view(np.int64).tolist()]
        wording = {slot[3] for slot, new in zip(slots, filled) if new and slot[2]}
        new = [slot for slot, new in zip(slots, filled) if new or slot[3] in wording]
        # where every slot is template, the host's pages are copies of each other, not a frame
        slots = new or slots
    return " ".join(text for _, text, _, _ in slots)


def _extract(page: pa.Array, template: pa.Array) -> pa.Array:
    known: dict = {}
    out = []
    for p, t in zip(page.to_pylist(), template.to_pylist()):
        key = tuple(t or ())
        out.append(main_text(p, known.setdefault(key, frozenset(key))))
    return pa.array(out, pa.string())


def extracted(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    A host's template texts are one array beside each of its pages: they stand on most pages, so there are
    no more of them than blocks on ``1 / MIN_SUPPORT`` pages."""
    texts = checkpointed(deduce(pages).where("text").select("host", "token"))
    template = texts.groupBy("host").agg(F.sort_array(F.collect_list("token")).alias("template"))
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), _host(pages).alias("host"))
    extract = F.arrow_udf(lambda p, t: _extract(p, t), "string")
    joined = _beside(rows, template, texts.limit(BROADCAST_TOKENS + 1).count(), "left")
    return joined.select("page_id", "url", extract("html", "template").alias("text")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
