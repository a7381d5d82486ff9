"""Main text of web pages by deducing the template that pages of a host share.

A page is a sequence of tokens: tags, told apart by the path of open elements, and text blocks. Tokens
of a host that occur equally often on each of its pages (equal occurrence vectors) form an
equivalence class. Classes whose tokens occur at most once a page and on most pages are valid; nested
in each other they make up the template, and what lies between their tokens are the slots. The main
slot is found by walking from the body into the template element that holds most of the running text;
on each page the blocks inside it are extracted, without constant text and without parts that are
menus, notices, adverts, forms or comments.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmart.llm.common import slices, texts
from hazardmart.llm.url_filter import url_host
from hazardmart.sources.landed import land

# Comments, declarations, tags (with quoted attribute values), or the text up to the next "<".
MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|([^<]+|<)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
TELLING = re.compile(r"class|id|role|hidden|display", re.IGNORECASE)
NOT_SHOWN = re.compile(r"(?:^|[;\s])display\s*:\s*none", re.IGNORECASE)
MAIN_STEP = re.compile(r"(?:^|\t)(?:article|main)(?:$|[.\t])")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Content without markup of its own, which ends with the page if nothing else ends it; and elements passed over whole.
RAW = frozenset("script style template textarea title iframe".split())
PASSED = frozenset("noscript svg object select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math mfrac mi mn mo mrow mstyle msub msup mtext q s samp small span strike strong sub sup time tt u var wbr".split()
)
# A start tag in the first set ends an open element in the second, if that is inside the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
PARAGRAPH_SCOPE = frozenset("article aside blockquote body button div footer form header li main nav section td th".split())

JUNK_TAGS = frozenset("nav footer aside header form button dialog menu".split())
JUNK_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
JUNK_NAMES = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets "
    "footer header masthead topbar cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription signup login form search "
    "comment comments reply replies respond disqus discussion "
    "share sharing social related recommended recommendations pagination pager copyright".split()
)
CONTAINERS = frozenset("html body main article section div center table tbody tr td".split())
# Names that say what an element is for as a whole, whatever else is in the name.
MAIN_NAMES = frozenset("article main content post entry story body page text".split())
# Names and tags of parts that can be longer than the main text without being it.
COMMENT_NAMES = frozenset("comment comments reply replies respond disqus discussion".split())
ASIDE_TAGS = frozenset("nav footer aside dialog menu".split())
HIDDEN, ASIDE, NAMED = "hidden", "aside", "named"
# Marked elements nested deeper than this share their ancestor's mark.
MARKED_DEPTH = 64


@dataclass
class Block:
    """A run of text between block boundaries: where it stands, and whether the page marks it as junk."""

    path: tuple[str, ...]
    text: str
    linked: int
    mark: int = -1
    in_main: bool = False
    junk: bool = False

    @property
    def running(self) -> int:
        """Characters that are no links."""
        return len(self.text) - self.linked


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    opened: dict[tuple[str, ...], int] = field(default_factory=lambda: defaultdict(int))


@dataclass
class Marked:
    """An element that its tag, name or attributes mark as junk.

    ``outer``: the marked element around it; ``kind`` and ``names``: what marks it; ``chars``: its
    running text; ``main_chars``: the part of it in ``article`` or ``main`` elements; ``holds_main``:
    whether a ``main`` is among them; ``inside_main``: whether it stands in one itself.
    """

    outer: int
    depth: int
    kind: str
    names: frozenset[str]
    inside_main: bool
    holds_main: bool = False
    chars: int = 0
    main_chars: int = 0
    kept: bool = False


def _attributes(attributes: str) -> dict[str, str]:
    """The attributes that may tell what an element is for, by lower-case name; the first of a name counts."""
    found: dict[str, str] = {}
    if attributes and TELLING.search(attributes):
        for name, *values in ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), "".join(values))
    return found


def _junk(tag: str, attributes: dict[str, str], inside_main: bool) -> tuple[str, frozenset[str]] | None:
    """What marks an element as menu, header, footer, sidebar, notice, advert, form, comment or hidden."""
    if tag in ("body", "html"):
        return None
    if "hidden" in attributes or NOT_SHOWN.search(attributes.get("style", "")) or attributes.get("aria-hidden", "").lower() == "true":
        return HIDDEN, frozenset({"hidden"})
    if tag in ("main", "article"):
        return None
    found: set[str] = set()
    for name in ("class", "id", "role"):
        names = {part.lower() for part in NAME_PARTS.findall(attributes.get(name, ""))}
        found |= names & (JUNK_ROLES | {"comment", "comments"})
        if not names & MAIN_NAMES:
            found |= names & JUNK_NAMES
    if tag in JUNK_TAGS and not (tag == "header" and inside_main):
        found.add(tag)
    if not found:
        return None
    return (ASIDE if tag in ASIDE_TAGS or found & COMMENT_NAMES else NAMED), frozenset(found)


def _keep_main(marked: list[Marked], blocks: list[Block]) -> None:
    """Take the mark off elements that hold the page's main text; set which blocks are junk.

    A marked element is no junk if it holds ``main``, or an ``article`` and more running text than is
    left unmarked, and no unmarked ``article`` or ``main`` has text; or if it (with those marked by
    the same names) holds most of the page's running text. Menus, footers, asides, comments and hidden
    elements can be long, so their text alone counts only if nothing else is left; nor does that of
    elements beside an unmarked ``article`` or ``main``. Outer elements are judged first.
    """

    def junk(mark: int) -> bool:
        while mark >= 0:
            if not marked[mark].kept:
                return True
            mark = marked[mark].outer
        return False

    for block in blocks:
        mark = block.mark
        while mark >= 0:
            marked[mark].chars += block.running
            marked[mark].main_chars += block.running if block.in_main else 0
            mark = marked[mark].outer
    total = sum(block.running for block in blocks)
    while True:
        outer = [one for one in marked if not one.kept and one.chars and not junk(one.outer)]
        clean = [block for block in blocks if not junk(block.mark)]
        rest = sum(block.running for block in clean)
        has_main = any(block.running for block in clean if block.in_main)
        free = [one for one in outer if not has_main or one.inside_main]
        held: dict[tuple[str, frozenset[str]], int] = defaultdict(int)
        for one in free:
            held[one.kind, one.names] += one.chars
        keep = [one for one in outer if not has_main and one.main_chars and (one.holds_main or one.chars > rest) and
                (one.kind != ASIDE or one.holds_main or 2 * one.chars > total)]
        keep = keep or [one for one in free if one.kind == NAMED and 2 * held[NAMED, one.names] > total]
        if not keep and not rest:
            for kind in (NAMED, ASIDE, HIDDEN):
                keep = keep or [one for one in free if one.kind == kind and (kind == NAMED or 2 * held[kind, one.names] > total)]
        if not keep:
            break
        for one in keep:
            one.kept = True
    for block in blocks:
        block.junk = junk(block.mark)


def _step(tag: str, attributes: dict[str, str]) -> str:
    """A tag with its class and id, without digits, as one step of a path."""
    named = [attributes[name] for name in attributes if name in ("class", "id", "role")]
    return tag + "." + re.sub(r"\d+", "", ".".join(named)) if named else tag


def parse(source: str) -> Page:
    """Text blocks and opened elements of a page; any string is accepted."""
    page = Page()
    # Open elements: tag, path, innermost marked element, link, in article or main, place of the innermost block.
    stack: list[tuple[str, tuple[str, ...], int, bool, bool, int]] = [("", (), -1, False, False, 0)]
    # By tag, the places of its open elements: no tag has to walk the stack.
    places: dict[str, list[int]] = defaultdict(list)
    marked: list[Marked] = []
    parts: list[str] = []
    linked = 0

    def close_block() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            _, path, mark, _, in_main, _ = stack[stack[-1][5]]
            page.blocks.append(Block(path, text, min(linked, len(text)), mark, in_main))
        linked = 0

    def innermost(tags) -> int:
        return max((places[tag][-1] for tag in tags if places.get(tag)), default=0)

    def close_from(depth: int) -> None:
        for entry in stack[depth:]:
            places[entry[0]].pop()
        del stack[depth:]

    def close_until(tags, scope) -> None:
        depth = innermost(tags)
        if depth and depth >= innermost(scope):
            close_block()
            close_from(depth)

    position = 0
    endless: set[str] = set()
    while match := MARKUP.match(source, position):
        position = match.end()
        closing, tag, attributes, closing2, tag2, attributes2, text = match.groups()
        if text is not None:
            parts.append(text)
            if stack[-1][3]:
                linked += len(text)
            continue
        tag, closing, attributes = (tag or tag2 or "").lower(), closing or closing2, attributes or attributes2 or ""
        if not tag:
            continue
        if closing:
            depth = innermost((tag,))
            if not depth and tag == "p" or depth and stack[-1][5] >= depth:
                close_block()
            if depth:
                close_from(depth)
            continue
        if tag in RAW or tag in PASSED:
            if tag != "svg":
                close_block()
            if not attributes.endswith("/") and tag not in endless:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(source, position)
                if end:
                    position = end.end()
                elif tag in RAW:
                    position = len(source)
                else:
                    endless.add(tag)
            continue
        if tag in ENDS:
            close_until(*ENDS[tag])
        if tag in ENDS_PARAGRAPH:
            close_until({"p"}, PARAGRAPH_SCOPE)
        if tag not in INLINE:
            close_block()
        if tag in VOID or attributes.endswith("/"):
            continue
        _, path, mark, link, in_main, block = stack[-1]
        known = _attributes(attributes)
        found = _junk(tag, known, in_main)
        if found and (mark < 0 or marked[mark].depth < MARKED_DEPTH):
            marked.append(Marked(mark, marked[mark].depth + 1 if mark >= 0 else 1, *found, in_main))
            mark = len(marked) - 1
        if tag in ("article", "main"):
            # Comments are often articles of their own.
            names = {part.lower() for name in ("class", "id") for part in NAME_PARTS.findall(known.get(name, ""))}
            in_main = in_main or not names & COMMENT_NAMES
            outer = mark
            while tag == "main" and outer >= 0:
                marked[outer].holds_main = True
                outer = marked[outer].outer
        if tag not in INLINE:
            if len(path) < 64:  # deeper elements share their ancestor's path
                path = (*path, _step(tag, known))
            page.opened[path] += 1
            block = len(stack)
        places[tag].append(len(stack))
        stack.append((tag, path, mark, link or tag == "a", in_main, block))
    close_block()
    if marked:
        _keep_main(marked, page.blocks)
    return page


def parsed(pages: DataFrame) -> DataFrame:
    """The pages (page_id, url, host, html) as opened elements and text blocks instead of html.

    ``opened`` has path, number of times and running text (characters that are no links and no
    junk) of each element path; ``blocks`` has path, text, a hash of both, whether it is junk, how many
    blocks of the page have that hash (with the first of them, else 0), and its running text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, opened, blocks = [], _Lists(3), _Lists(6)
            for source in texts(batch, "html"):
                page = parse(source)
                keys.append(xxhash.xxh3_64_intdigest(source.encode("utf-8", "surrogatepass")) >> 1)
                running: dict[tuple[str, ...], int] = defaultdict(int)
                paths = ["\t".join(block.path) for block in page.blocks]
                marks = [
                    xxhash.xxh3_64_intdigest(f"{path}\n{block.text}".encode("utf-8", "surrogatepass")) >> 1
                    for path, block in zip(paths, page.blocks, strict=True)
                ]
                times = Counter(marks)
                for path, mark, block in zip(paths, marks, page.blocks, strict=True):
                    blocks.add(path, block.text, mark, block.junk, times.pop(mark, 0), block.running)
                    if not block.junk:
                        for depth in range(1, len(block.path) + 1):
                            running[block.path[:depth]] += block.running
                for path, times in page.opened.items():
                    opened.add("\t".join(path), times, running[path])
                opened.end()
                blocks.end()
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("page_id", "url", "host")),
                    pa.array(keys, pa.int64()),
                    opened.array({"path": pa.string(), "times": pa.int64(), "chars": pa.int64()}),
                    blocks.array(BLOCK),
                ],
                names=["page_id", "url", "host", "page_key", "opened", "blocks"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.mapInArrow(
        run,
        f"page_id {kind}, url string, host string, page_key long, "
        "opened array<struct<path: string, times: long, chars: long>>, "
        "blocks array<struct<path: string, text: string, mark: long, junk: boolean, times: int, running: int>>",
    )


BLOCK = {"path": pa.string(), "text": pa.string(), "mark": pa.int64(), "junk": pa.bool_(), "times": pa.int32(), "running": pa.int32()}


class _Lists:
    """Rows of lists of structs, gathered column by column."""

    def __init__(self, fields: int):
        self.columns: list[list] = [[] for _ in range(fields)]
        self.offsets = [0]

    def add(self, *values) -> None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)

    def end(self) -> None:
        self.offsets.append(len(self.columns[0]))

    def array(self, kinds: dict[str, pa.DataType]) -> pa.ListArray:
        arrays = [pa.array(column, kind) for column, kind in zip(self.columns, kinds.values(), strict=True)]
        return pa.ListArray.from_arrays(pa.array(self.offsets, pa.int32()), pa.StructArray.from_arrays(arrays, names=[*kinds]))


@dataclass(frozen=True)
class TemplateOptions:
    """``support``: least share of a host's pages that a template element is on; ``repeated``: largest
    share of a token's pages (but at least one page) that may have it more than once;
    ``same``: least share of an element's pages that a text of its class is on; ``constant_pages``:
    least pages of a host on which constant text can be told from content; ``share``: of the running
    text that an element must hold to be walked into.
    """

    support: float = 0.5
    repeated: float = 0.05
    same: float = 0.9
    constant_pages: int = 10
    share: float = 0.7


def _vector(*parts: str | Column) -> Column:
    """Sum of hashes of page and count over the pages of a token.

    Equal occurrence vectors have equal sums, in whatever order and on whatever machine pages are
    counted, and the sum is partly formed before the shuffle.
    """
    return F.sum(F.xxhash64(*parts).cast("decimal(38,0)"))


def templates(pages: DataFrame, options: TemplateOptions = TemplateOptions()) -> DataFrame:
    """Per host of parsed pages: its main path, the template's other parts, and its constant text blocks.

    Pages without any text do not count. Valid tokens are on most pages, and on nearly all of those
    once. As many tokens as are on half of the pages fit one page twice, which bounds a host's
    template however many pages it has.
    """
    pages = pages.filter(F.size("blocks") > 0)
    totals = pages.groupBy("host").agg(F.count("*").alias("all_pages"))
    opened = pages.select("host", "page_key", F.explode("opened").alias("e")).select("host", "page_key", "e.*")
    counted = F.count("*").alias("pages"), F.count_if(F.col("times") == 1).alias("once"), _vector("page_key", "times").alias("vector")
    elements = opened.groupBy("host", "path").agg(*counted, F.sum("chars").alias("chars"))
    blocks = pages.select("host", "page_key", F.explode("blocks").alias("b")).filter("NOT b.junk AND b.times > 0")
    marks = blocks.select("host", "page_key", "b.mark", F.xxhash64("b.path").alias("place"), F.col("b.times").cast("long").alias("times"))
    marks = marks.groupBy("host", "mark").agg(*counted, F.min("place").alias("place"))
    more = F.col("pages") - F.col("once")
    once = (more <= F.greatest(F.lit(1), options.repeated * F.col("pages"))) & (2 * more <= F.col("pages"))
    valid = once & (F.col("pages") >= options.support * F.col("all_pages"))
    valid_text = once & (F.col("pages") >= options.same * options.support * F.col("all_pages"))
    # Only the template's texts are given their path, which all others would carry through the shuffle.
    paths = elements.select("host", "path", F.xxhash64("path").alias("place"))
    texts_of = marks.join(totals, "host").filter(valid_text).join(paths, ["host", "place"], "left").drop("place")
    texts_of = texts_of.withColumn("path", F.coalesce("path", F.lit(""))).withColumn("chars", F.lit(0).cast("long"))
    tokens = elements.withColumn("mark", F.lit(None).cast("long")).join(totals, "host").filter(valid).unionByName(texts_of)
    token = F.struct("path", "mark", "pages", "chars", "vector")
    hosts = tokens.groupBy("host").agg(
        F.first("all_pages").alias("all_pages"), F.sort_array(F.collect_list(token)).alias("tokens")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = batch.to_pylist()
            found = [deduce(row["tokens"], row["all_pages"], options) for row in rows]
            kinds = pa.string(), pa.list_(pa.string()), pa.list_(pa.int64())
            arrays = [pa.array([parts[i] for parts in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("host"), *arrays], names=["host", "main", "sides", "constants"])

    return hosts.mapInArrow(run, "host string, main string, sides array<string>, constants array<bigint>")


@dataclass
class Slot:
    """What an element of the template encloses: the tokens of its class there, and nested classes' elements.

    Between the start of the element, its constant texts, the nested elements and its end lies the
    content of the pages.
    """

    pages: int
    vector: Decimal | None
    chars: int = 0
    texts: list[tuple[int, int]] = field(default_factory=list)
    nested: list[str] = field(default_factory=list)


def nested_classes(tokens: list[dict], all_pages: int, same: float) -> dict[str, Slot]:
    """The slots of a host's template by the path of their element; "" is the page itself.

    Equivalence classes are told apart by vector, and nested where the element nearest around a class
    is of another. A text belongs to the template if it comes and goes with an element: if one of its
    class stands in the same slot, or if it is on nearly all pages of the element around it. (It
    can be on no others, so that the vectors differ in the odd page only.)
    """
    slots = {"": Slot(all_pages, None)}
    for token in tokens:
        if token["mark"] is None:
            slots[token["path"]] = Slot(token["pages"], token["vector"], token["chars"])
    for path in sorted(slots):
        if path:
            slots[_enclosing(path.rpartition("\t")[0], slots)].nested.append(path)
    for token in tokens:
        if token["mark"] is not None:
            path = _enclosing(token["path"], slots)
            beside = any(slots[other].vector == token["vector"] for other in slots[path].nested)
            if beside or token["pages"] >= same * slots[path].pages:
                slots[path].texts.append((token["mark"], token["pages"]))
    return slots


def _enclosing(path: str, slots: dict[str, Slot]) -> str:
    while path not in slots:
        path = path.rpartition("\t")[0]
    return path


def deduce(tokens: list[dict], all_pages: int, options: TemplateOptions) -> tuple[str, list[str], list[int]]:
    """Main path, elements beside the way to it, and constant texts of a host from its valid tokens."""
    slots = nested_classes(tokens, all_pages, options.same)
    constants = [mark for slot in slots.values() for mark, pages in slot.texts if pages >= options.constant_pages]
    main = main_path(slots, options.share)
    around = [path for path in slots if main != path and (not path or main.startswith(path + "\t"))]
    sides = [path for outer in around for path in slots[outer].nested if path != main and path not in around]
    return main, sorted(sides), sorted(constants)


def main_path(slots: dict[str, Slot], share: float) -> str:
    """The deepest container's slot on the way along which most of the running text lies.

    The way ends at an ``article`` or ``main`` element, whose parts belong together.
    """
    main, held = "", 0
    while _tag(main) not in ("article", "main"):
        nearest, waiting = [], [*slots[main].nested]
        while waiting:  # elements that are no containers are looked through
            path = waiting.pop()
            if _tag(path) in CONTAINERS:
                nearest.append(path)
            else:
                waiting += slots[path].nested
        best = max(nearest, key=lambda path: (slots[path].chars, path), default=None)
        if best is None or not slots[best].chars or slots[best].chars < share * held:
            break
        main, held = best, slots[best].chars
    return main


def _tag(path: str) -> str:
    return path.rpartition("\t")[2].partition(".")[0]


def _within(path: str, outer: str) -> bool:
    return not outer or path == outer or path.startswith(outer + "\t")


def main_blocks(blocks: list[dict], main: str, sides: list[str], constants: set[int], share: float) -> list[dict]:
    """The blocks inside the main path, without junk and constants.

    The main path counts on a page only if it holds the share of the page's running text there;
    constants and those other parts of the template that are no longer than it are left out of that.
    Other pages give their ``article`` or ``main`` elements if these hold most of the running text, else all blocks.
    Constants are kept where they are most of what is left: then the pages are copies of each other.
    """
    clean = [b for b in blocks if not b["junk"]]
    inside = [b for b in clean if _within(b["path"], main)]
    own, other, beside = sum(b["running"] for b in inside), 0, defaultdict(int)
    if main:
        for b in clean:
            if b["mark"] not in constants and not _within(b["path"], main):
                side = next((side for side in sides if _within(b["path"], side)), None)
                if side is None:
                    other += b["running"]
                else:
                    beside[side] += b["running"]
    other += sum(chars for chars in beside.values() if chars > own)
    if inside and own >= share * (own + other):
        picked = inside
    else:
        picked = [b for b in clean if MAIN_STEP.search(b["path"])]
        if not picked or 2 * sum(b["running"] for b in picked) < sum(b["running"] for b in clean if b["mark"] not in constants):
            picked = clean
    varied = [b for b in picked if b["mark"] not in constants]
    return picked if 2 * _chars(varied) < _chars(picked) else varied


def _chars(blocks: list[dict]) -> int:
    return sum(len(b["text"]) for b in blocks)


def main_text(pages: DataFrame, options: TemplateOptions = TemplateOptions()) -> DataFrame:
    """Per row: page_id, url, the main text of the page and its length in code points.

    Null html counts as empty and gives the empty text; pages whose url has no host share one
    template; repeated rows count as pages of their own and give repeated results. Other columns are
    not read. An empty table gives an empty result. Each page is parsed once; the parsed pages are
    written, and the templates' file decides whether they are broadcast.
    """
    hosted = pages.select("page_id", "url", url_host(F.col("url")).alias("host"), F.col("html").cast("string"))
    rows = land(parsed(hosted), "pages")
    found = rows.join(land(templates(rows, options), "templates"), "host", "left")
    found = found.select("page_id", "url", "blocks", "main", "sides", "constants")
    kind, share = pages.schema["page_id"].dataType.simpleString(), options.share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = []
            for blocks, main, sides, constants in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                own = main_blocks(blocks, main or "", sides or [], set(constants or ()), share)
                kept.append(" ".join(b["text"] for b in own))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(kept, pa.string())], names=["page_id", "url", "text"]
            )

    named = found.mapInArrow(run, f"page_id {kind}, url string, text string")
    return named.select("*", F.length("text").cast("long").alias("n_chars"))
