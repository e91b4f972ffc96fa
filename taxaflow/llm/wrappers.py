"""Main text of web pages by wrappers: union-free regular expressions of a host's pages (Crescenzi et al., 2001).

A wrapper describes a host's pages as nested elements with text in between. Pages are aligned with it one after the
other: texts that differ become slots, elements that only some pages have become optional, and runs of alike elements
become repeated groups. Aligning two wrappers works alike, so each task builds one for the pages of a host that
it holds, and the tasks' wrappers, a few small rows a host, are aligned afterwards.

The wrapper then decides what is text. Its slots lead from the page down to the lowest part that holds the host's variable
text; inside that part, boxes that the host repeats on all pages are left out, and paragraphs that it repeats before the first or after the
last variable text; and so is what names or tags hint at as standing around articles, unless hints leave nothing. A page is aligned with the decided wrapper of its host, and its text is what stands
in the elements that are aligned with the main part and with nothing left out.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import written
from .html_tree import AROUND, HEADINGS, Link, Node, blocks, parse

#: Elements that are text of their own, not boxes around other elements (fixed values).
LAYOUT = {"table", "tbody", "thead", "tfoot", "tr", "td", "th"}
LISTS = {"ul", "ol"}
PROSE = HEADINGS | LAYOUT | LISTS | {"p", "blockquote", "pre", "figure", "figcaption", "li", "dl", "dt", "dd", "address", "hr", "details", "summary"}
#: Elements that a text repeats with constant words without their being the host's own (fixed values).
LABELS = HEADINGS | LAYOUT | {"li", "dt", "dd", "figcaption", "summary"}
#: Prose that an article may quote word by word as others of its host do (fixed values).
QUOTED = {"p", "pre", "blockquote"}
ARTICLES = {"article", "main"}
PAGES = {"#root", "html", "body"}
LONGEST = 200  # items side by side; longer runs are described as one repeated group of optional elements
MOST_KEYS = 500  # kinds of elements in such a group; with more, elements are told apart by tag only
HOSTS_AT_ONCE = 2_000  # wrappers that a task holds before it hands them on
VARIED = 0.05  # of a host's text must differ, or constant text counts as well
HALF = 0.5  # of the text in sight must be in an element to be gone into
PART = 0.1  # of that element's text makes a box beside it a part of the article
LITTLE = 0.05  # of the text at least must be left by hints
MERGED_APART = 64  # groups in which a host's wrappers are merged before these are

#: Decisions on parts: text stays, is left out, is left out in part; the way down to the main part, and the main part.
KEEP, DROP, MIXED, PATH, MAIN = "keep", "drop", "mixed", "path", "main"

sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))  # pages are up to 512 elements deep


class Part:
    """An item of a wrapper: a text (constant: its hash; a slot: None), an element, or a repeated group of items."""

    __slots__ = ("key", "parts", "text", "chars", "links", "hint", "optional", "repeated", "decision", "nodes")

    def __init__(self, key, parts=(), text=None, chars=0, links=0, hint=False, optional=False, repeated=False, decision=KEEP, nodes=()):
        self.key, self.parts, self.text, self.chars, self.links = key, list(parts), text, chars, links
        self.hint, self.optional, self.repeated, self.decision, self.nodes = hint, optional, repeated, decision, list(nodes)

    @property
    def tag(self) -> str:
        return self.key.partition("/")[0].partition(".")[0]

    @property
    def kind(self) -> str:
        return self.key.partition("/")[2]

    @property
    def is_text(self) -> bool:
        return self.key == "#text"

    @property
    def is_group(self) -> bool:
        return self.key[0] in "(*"

    def dump(self) -> list:
        return [self.key, [x.dump() for x in self.parts], self.text, self.chars, self.links, self.hint, self.optional, self.repeated, self.decision]

    def again(self) -> Part:
        """Another turn of it that no page has."""
        return Part(self.key, [x.again() for x in self.parts], self.text, 0, 0, self.hint, self.optional, self.repeated, self.decision)


def load(dumped: list) -> Part:
    return Part(dumped[0], map(load, dumped[1]), *dumped[2:])


def _size(parts: Iterable[Part]) -> tuple[int, int]:
    """Characters, and those of them in links."""
    sizes = [(p.chars, p.links) if p.is_text else _size(p.parts) for p in parts]
    return sum(c for c, _ in sizes), sum(n for _, n in sizes)


def wrapper_of(node: Node, keep_nodes: bool = False) -> Part:
    """A page's own wrapper: all texts constant, repeated runs folded. Boxes are told apart by tag, classes and what they
    hold: a title, links, other blocks, bare text or nothing."""
    parts: list[Part] = []
    run: list[str] = []

    def flush() -> None:
        if whole := " ".join("".join(run).split()):
            linked = sum(len(x) for x in run if isinstance(x, Link))
            parts.append(Part("#text", (), xxh64_intdigest(whole), len(whole), min(linked, len(whole))))
        run.clear()

    for x in node.items:
        if isinstance(x, str):
            run.append(x)
            continue
        flush()
        if not x.hidden:
            parts.append(wrapper_of(x, keep_nodes))
    flush()
    key = node.label
    if node.tag in LISTS or node.tag not in PROSE:
        chars, links = _size(parts)
        if any(p.tag == "h1" or p.kind == "titled" for p in parts):
            key += "/titled"
        else:
            key += "/links" if links > 0.8 * chars else "/blocks" if any(not p.is_text for p in parts) else "/text" if chars else "/none"
    return Part(key, fold(parts), hint=node.around, nodes=[node] if keep_nodes else ())


def fold(parts: list[Part]) -> list[Part]:
    """Joins neighbouring runs of the same keys into repeated elements and groups, short periods first.

    A run of period w shows as w places or more in a row whose last like item is w places before, so a period may
    have any length, and each round looks at every item once.
    """
    while True:
        last: dict[str, int] = {}
        back = []
        for i, p in enumerate(parts):
            back.append(i - last.get(p.key, i))
            last[p.key] = i
        runs, i = [], 0  # (period, first, end) of whole turns
        while i < len(parts):
            j = i
            while j < len(parts) and back[j] == back[i]:
                j += 1
            if back[i] and j - i >= back[i] and parts[i].key != "#text":
                runs.append((back[i], i - back[i], j - (j - i) % back[i]))
            i = j
        if not runs:
            return _starred(parts) if len(parts) > LONGEST else parts
        shortest = min(w for w, _, _ in runs)
        out, done = [], 0
        for w, start, end in runs:
            if w != shortest or start < done:
                continue
            out += parts[done:start]
            turn = parts[start : start + w]
            for at in range(start + w, end):
                merge(turn[(at - start) % w], parts[at])
            if w > 1:
                turn = [Part("(" + " ".join(p.key for p in turn) + ")", turn)]
            turn[0].repeated = True
            out += turn
            done = end
        parts = out + parts[done:]


def _starred(parts: list[Part]) -> list[Part]:
    """One repeated group of optional elements, one for each key in order of appearance. It describes any run of these."""
    found: dict[str, Part] = {}
    for plain in (False, True):
        for p in _turns(parts, 1):
            if plain and not p.is_text:
                p.key = _plain_key(p)
            if found.setdefault(p.key, p) is not p:
                merge(found[p.key], p)
        if len(found) <= MOST_KEYS:
            break
        parts, found = list(found.values()), {}
    for p in found.values():
        p.optional = p.repeated = True
    return [Part("*", found.values(), repeated=True)]


def _plain_key(part: Part) -> str:
    tag = part.tag if part.tag in PROSE or part.tag in AROUND or part.tag in ARTICLES or part.tag in ("div", "section") else "?"
    return f"{tag}/{part.kind}" if part.kind else tag


def _turns(parts: list[Part], times: int = 2) -> list[Part]:
    """Items with their groups written out, so that groups align with single turns; no page's text comes twice."""
    out: list[Part] = []
    for p in parts:
        if p.is_group:
            out += p.parts
            if times > 1 and p.key != "*":
                out += [x.again() for x in p.parts]
        else:
            out.append(p)
    return out


def merge(a: Part, b: Part) -> Part:
    """Part a describes from now on also what b does, which has the same key."""
    a.optional |= b.optional
    a.repeated |= b.repeated
    a.hint &= b.hint
    a.nodes += b.nodes
    if a.is_text:
        a.text = a.text if a.text == b.text else None
        a.chars, a.links = a.chars + b.chars, a.links + b.links
    else:
        a.parts = align(a.parts, b.parts)
    return a


def _matches(a: list[Part], b: list[Part]) -> list[tuple[int, int, int]]:
    """(place in a, place in b, length) of runs of the same keys, in order."""
    ka, kb = [p.key for p in a], [p.key for p in b]
    if ka == kb:
        return [(0, 0, len(a)), (len(a), len(b), 0)]
    return SequenceMatcher(None, ka, kb, autojunk=False).get_matching_blocks()


def align(a: list[Part], b: list[Part]) -> list[Part]:
    """The wrapper of what either wrapper describes: what one of them lacks becomes optional. Changes both."""
    if [p.key for p in a] == [p.key for p in b]:
        return [merge(x, y) for x, y in zip(a, b, strict=True)]
    if any(p.key == "*" for p in (*a, *b)):
        return _starred(a + b)
    a, b = _turns(a), _turns(b)
    out: list[Part] = []
    i = j = 0
    for x, y, n in _matches(a, b):
        for p in (*a[i:x], *b[j:y]):
            p.optional = True
            out.append(p)
        out += [merge(p, q) for p, q in zip(a[x : x + n], b[y : y + n], strict=True)]
        i, j = x + n, y + n
    return fold(out)


class Decision:
    """What of a host's wrapper is text. slots: only variable text counts as text of the pages."""

    def __init__(self, root: Part, pages: int):
        self.root, self.pages, self.slots = root, pages, False
        whole = self._weigh(root, hints=False)
        self.slots = pages > 1
        if self._weigh(root, hints=False) < VARIED * whole:
            self.slots = False
        self.weights: dict[int, int] = {}
        self._clear_hints()
        self._find_main()

    def _weigh(self, part: Part, hints: bool = True) -> int:
        """Characters outside links; with ``hints``, of parts without a hint, and noted."""
        if part.is_text:
            weight = 0 if self.slots and part.text is not None else part.chars - part.links
        else:
            own = [(p, self._weigh(p, hints)) for p in part.parts]
            weight = sum(w for p, w in own if not (hints and p.hint))
        if hints:
            self.weights[id(part)] = weight
        return weight

    def weight(self, part: Part) -> int:
        return 0 if part.hint else self.weights[id(part)]

    def _holds(self, part: Part, tags: set[str], weight: int = 1) -> bool:
        return any(p.tag in tags and self.weights[id(p)] >= weight or self._holds(p, tags, weight) for p in part.parts)

    def _clear_hints(self) -> None:
        """Where hints leave next to nothing, the heaviest form, or hinted box around an article, is none."""
        while self._weigh(self.root) < LITTLE * self._weigh(self.root, hints=False):
            hinted, todo = [], [self.root]
            while todo:
                p = todo.pop()
                if p.hint:
                    if p.tag == "form" and self._holds(p, HEADINGS | ARTICLES | {"p"}) or p.tag not in AROUND and self._holds(p, ARTICLES | {"h1"}):
                        hinted.append(p)
                else:
                    todo += p.parts
            if not hinted:
                break
            max(hinted, key=lambda p: self.weights[id(p)]).hint = False

    def _is_prose(self, part: Part) -> bool:
        return part.tag in PROSE and not (part.tag in LAYOUT and self._holds(part, HEADINGS | {"p", "div"}))

    def _is_part(self, beside: Part, heavy: Part) -> bool:
        """Whether what stands beside the heaviest box belongs to the article as well."""
        weight = self.weight(beside)
        if not weight:
            return False
        if beside.tag in ("h1", "h2") or beside.kind == "titled" and self._holds(beside, {"h1"}):
            return True
        if heavy.tag in ARTICLES:
            return False
        if beside.is_text:
            return weight >= PART * self.weight(heavy)
        if beside.is_group:
            return any(self._is_part(p, heavy) for p in beside.parts)
        return self._is_prose(beside) or beside.kind in ("titled", "blocks") and weight >= PART * self.weight(heavy)

    def _find_main(self) -> None:
        here, everywhere = self.root, True  # everywhere: all pages have the main part
        here.decision = PATH
        while here.tag != "article":
            heavy = max((p for p in here.parts if not p.is_text), key=self.weight, default=None)
            if heavy is None or heavy.is_group or heavy.repeated or not self.weight(heavy) or self.weight(heavy) < HALF * sum(map(self.weight, here.parts)):
                break
            if self._is_prose(heavy) or any(self._is_part(p, heavy) for p in here.parts if p is not heavy):
                break
            for p in here.parts:
                p.decision = PATH if p is heavy else DROP
            here, everywhere = heavy, everywhere and not heavy.optional
        here.decision = MAIN
        self._mark(here.parts, here.tag, self.slots and everywhere)
        if here.tag not in ARTICLES:
            for side in (here.parts, here.parts[::-1]):
                self._trim(side, here.tag in PAGES)

    def _mark(self, parts: list[Part], main: str, constants: bool, before: bool = False, after: bool = False) -> None:
        """before, after: whether variable text of the main part stands before and after these parts."""
        varies = [_varies(p) for p in parts]
        last = max((i for i, x in enumerate(varies) if x), default=-1)
        for i, p in enumerate(parts):
            later = after or i < last
            if not p.is_text:
                repeats = constants and self._is_constant(p) and not (p.tag in QUOTED and before and later)
                if p.hint and not (main not in PAGES and "header" in p.key and self._holds(p, HEADINGS)) or repeats:
                    p.decision = DROP
                else:
                    self._mark(p.parts, main, constants and not (p.repeated or p.optional), before, later)
                    p.decision = KEEP if all(x.decision == KEEP for x in p.parts) else MIXED
            before = before or varies[i]

    def _is_constant(self, part: Part) -> bool:
        """Whether all pages have it with the same words: the host's own text, not an article's."""

        def same(p: Part) -> bool:
            return p.text is not None and not p.optional if p.is_text else not (p.optional or p.repeated or p.tag in LABELS) and all(map(same, p.parts))

        return _size([part])[0] > 0 and same(part)

    def _trim(self, parts: list[Part], whole_page: bool) -> None:
        """Boxes of links, and on a whole page boxes of bare text, before the first and after the last part are no article."""
        kinds = ("links", "text", "none") if whole_page else ("links", "none")
        edge = [not p.is_text and not p.repeated and p.kind in kinds for p in parts]
        if all(edge):
            return
        for p in parts[: edge.index(False)]:
            p.decision = DROP


def _varies(part: Part) -> bool:
    """Whether it holds text that not all pages have alike."""
    if part.is_text:
        return part.text is None or part.optional
    return part.optional and _size([part])[0] > 0 or any(map(_varies, part.parts))


def decided(root: Part, pages: int = 1) -> Part:
    """The wrapper with its decisions, without what they don't need."""
    Decision(root, pages)

    def prune(p: Part) -> Part:
        if p.decision in (KEEP, DROP) and not p.is_group:
            p.parts = []
        for x in p.parts:
            prune(x)
        return p

    return prune(root)


def _pairs(host: list[Part], own: list[Part]) -> tuple[list[tuple[Part, Part]], list[Part]]:
    """Parts of a host's wrapper with those of a page that they describe, and parts of the page that none describes."""
    starred = any(p.key == "*" for p in (*host, *own))
    host, own = _turns(host), _turns(own)
    if starred:
        known = {p.key: p for p in reversed(host)}
        found = [(known.get(p.key) or known.get(_plain_key(p)), p) for p in own]
        return [(h, p) for h, p in found if h], [p for h, p in found if not h]
    pairs, i, j = [], set(), set()
    for x, y, n in _matches(host, own):
        pairs += zip(host[x : x + n], own[y : y + n], strict=True)
        i |= set(range(x, x + n))
        j |= set(range(y, y + n))
    for x, h in enumerate(host):
        if x not in i and h.decision in (PATH, MAIN):  # classes and kinds may differ on the way down
            rest = [y for y, p in enumerate(own) if y not in j and p.tag == h.tag and not p.hint]
            same = [y for y in rest if own[y].key.partition("/")[0] == h.key.partition("/")[0]] or rest
            if same:
                pairs.append((h, own[same[0]]))
                j.add(same[0])
    return pairs, [p for y, p in enumerate(own) if y not in j]


def _left_out(host: list[Part], own: list[Part], out: set[int]) -> None:
    """Adds the page's elements that the wrapper leaves out."""
    pairs, unknown = _pairs(host, own)
    for h, p in pairs:
        if h.decision == DROP:
            out |= set(map(id, p.nodes))
        elif h.decision == MIXED:
            _left_out(h.parts, p.parts, out)
    for p in unknown:
        if p.hint:
            out |= set(map(id, p.nodes))


def _texts(host: Part, own: Part) -> list[str]:
    if host.decision == MAIN:
        out: set[int] = set()
        _left_out(host.parts, own.parts, out)
        return [b for n in own.nodes for b in blocks(n, out)]
    return [b for h, p in _pairs(host.parts, own.parts)[0] if h.decision in (PATH, MAIN) for b in _texts(h, p)]


def main_text(html: str, wrapper: Part | None = None) -> str:
    """Blocks of the main part, joined by an empty line. A page that the wrapper doesn't fit is judged by itself."""
    own = wrapper_of(parse(html), keep_nodes=True)
    texts = _texts(wrapper, own) if wrapper else []
    if not texts:
        Decision(own, 1)
        texts = _texts(own, own)
    return "\n\n".join(texts)


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the decided wrapper of each host's pages, as JSON. pages: host and html.

    All pages of all hosts are aligned. A task hands on one small wrapper for each host that it meets, so a host of
    any size comes down to a row a task, and these are merged in groups of tasks first.
    """

    def own(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[int, Part]] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"host": list(held), "pages": [n for n, _ in held.values()], "wrapper": [json.dumps(w.dump()) for _, w in held.values()]})

        for batch in batches:
            for host, html in zip(batch["host"], batch["html"], strict=True):
                host, new = host.as_py(), wrapper_of(parse(html.as_py()))
                held[host] = (held[host][0] + 1, _joined(held[host][1], new)) if host in held else (1, new)
                if len(held) >= HOSTS_AT_ONCE:
                    yield out()
                    held.clear()
        if held:
            yield out()

    def merged(table: pa.Table) -> tuple[Part, int]:
        root = None
        for w in sorted(table["wrapper"].to_pylist()):
            root = load(json.loads(w)) if root is None else _joined(root, load(json.loads(w)))
        return root, sum(table["pages"].to_pylist())

    def some(table: pa.Table) -> pa.Table:
        root, n = merged(table)
        return pa.table({"host": table["host"][:1], "pages": [n], "wrapper": [json.dumps(root.dump())]})

    def whole(table: pa.Table) -> pa.Table:
        return pa.table({"host": table["host"][:1], "wrapper": [json.dumps(decided(*merged(table)).dump())]})

    schema = "host string, pages long, wrapper string"
    parts = pages.select("host", "html").mapInArrow(own, schema).withColumn("group", F.spark_partition_id() % MERGED_APART)
    return parts.groupBy("host", "group").applyInArrow(some, schema).groupBy("host").applyInArrow(whole, "host string, wrapper string")


def _joined(a: Part, b: Part) -> Part:
    """Roots of pages differ in kind only."""
    b.key = a.key
    return merge(a, b)


def extract_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """page_id, url, text (main text, "" if none), n_chars (code points) of each page.

    A null or empty html has no text; a null url, or one without a host, belongs to the host "". Repeated rows
    are extracted one by one; other columns are not read; an empty table gives an empty result. Pages of any
    length and nesting are read in time that grows with their length.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), host.alias("host"))
    wrappers = written(infer_wrappers(rows), "wrappers")

    @F.arrow_udf("string")
    def extract(htmls: pa.Array, found: pa.Array) -> pa.Array:
        known: dict[str, Part] = {}
        out = []
        for html, wrapper in zip(htmls, found, strict=True):
            wrapper = wrapper.as_py()
            if wrapper not in known:
                known[wrapper] = load(json.loads(wrapper))
            out.append(main_text(html.as_py(), known[wrapper]))
        return pa.array(out, pa.string())

    # Spark broadcasts the wrappers only if they are small; else a host with very many pages is split by AQE.
    found = rows.join(wrappers, "host").withColumn("text", extract("html", "wrapper"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
