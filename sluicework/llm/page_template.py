"""Main text of web pages, by template deduction over equivalence classes of tokens.

Pages of one host come from a few templates.  A token is an element, or a whole block of text,
together with its path of elements.  Its occurrence vector over the host's pages is summed up as
the number of pages, the number of occurrences and a sum of page hashes, so vectors of any length
are compared by three numbers that tasks can add up.  Tokens with one vector form an equivalence
class.  A class is valid when it is large and frequent (``LEAST_TOKENS``, ``LEAST_PAGES``,
``PAGE_PERCENT``), in pages of differing text, and holds an element: text alone that always comes
together is as well a text that was copied.  A class belongs to the pages that have its elements, so
each layout of a host has classes of its own and none must be in most of the host's pages.

Blocks of text in valid classes are a template's constants; what differs between pages fills its
slots, a slot being an element with the text directly in it, weighed by the mean characters, less
constants, that it holds in a page that has it.  Valid classes nest along the paths of their
elements, as an element is never in more pages than its parent.  The main slot of a page is found
down that nesting: from the whole page to the element below that holds more than half of the weight,
as long as there is one.

A page's text is what the main slot holds, all that is below it, less constants.  Blocks below
``article`` or ``main`` are taken instead unless the host's template weighs the main slot outside
of these more; of an article nothing is a constant, since texts of one host may share a title or a
paragraph.  What elements of other roles (menus, adverts, comments) hold is left out in both.  A class
name has the role of its head word: ``cookie-notice`` is a notice, ``notice-quote`` is none.  Roles
named on ``html``, ``body`` or ``main`` do not count, and those on or around all articles of a page do
not empty it.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicework.llm.arrow import map_batches
from sluicework.sources.storage import Staging

# Names of HTML.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav"
    " noscript ol option p pre section select summary table tbody td template textarea tfoot th"
    " thead title tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_MAIN = frozenset(("article", "main"))
# What these are named says how a page looks, not what it holds.
_WHOLE = frozenset(("html", "body", "main"))
# An open element of these ends where the next of them, or another block, starts.
_ENDED_BY_BLOCK = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6"))
_ENDED_BY_SAME = frozenset("li dt dd option tr td th".split())

# Elements, and words in their class, id or role, that hold no main text.
OTHER_ELEMENTS = frozenset(
    "aside button dialog footer form head header menu nav noscript option select template textarea"
    " title iframe object svg canvas audio video".split()
)
OTHER_ROLES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs"
    " byline comment comments commentlist consent contentinfo cookie cookies copyright disclaimer"
    " discussion disqus footer gdpr header login masthead menu modal nav navbar navigation"
    " newsletter notice notices pager pagination popup promo promoted promotion related replies"
    " reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe"
    " subscription tags teaser toolbar topbar widget widgets".split()
)

# Words at the end of a class name that say what kind of box it is, and at its start what it has.
BOX_WORDS = frozenset(
    "area bar block body bottom box button buttons col column container content group holder inner"
    " item items left link links list panel results right row section slot text title top unit"
    " wrap wrapper".split()
)
STATE_WORDS = frozenset("has is no with without".split())

# A class is frequent from so many pages, and from this share of the host's pages, and large from
# so many tokens.  By the share a host has at most 100 times the tokens of its average page.
LEAST_PAGES = 5
PAGE_PERCENT = 1
LEAST_TOKENS = 2
# Template entries (16 bytes and more) up to which the templates go to every task.
BROADCAST_ENTRIES = 300_000
SALTS = 16

_TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|xmp|plaintext)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|([^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTES = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAMES = re.compile(r"[a-z]+")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_NUMBERED = re.compile(r"[0-9][A-Za-z0-9]*")


class Block(NamedTuple):
    path: str  # names of the open elements, outermost first
    text: str
    main: bool  # below an article
    other: bool  # below an element of another role
    inner: bool  # below an element of another role that is itself below the article


class _Open(NamedTuple):
    name: str
    label: str
    main: bool
    other: bool
    inner: bool


def _is_other(name: str) -> bool:
    """Whether one class name, id or role says that an element holds no main text.

    Words are told apart by signs, digits and capitals.  The last one that is more than a kind of
    box decides, or all words written as one.
    """
    words = [w.lower() for w in _WORDS.findall(_NUMBERED.sub(" ", name))]
    if not words or words[0] in STATE_WORDS:
        return False
    if "".join(words) in OTHER_ROLES:
        return True
    while words and words[-1] in BOX_WORDS:
        words.pop()
    return bool(words) and words[-1] in OTHER_ROLES


def _roles(attributes: str) -> tuple[str, bool]:
    """The class names for the path, and whether a name has another role than main text."""
    label, other = "", False
    for found in _ATTRIBUTES.finditer(attributes):
        value = found[2] or found[3] or found[4] or ""
        other = other or any(map(_is_other, value.split()))
        if found[1].lower() == "class":
            label = "." + ".".join(sorted(set(_NAMES.findall(value.lower()))))
    return label, other


def parse(page: str) -> tuple[list[Block], Counter]:
    """The blocks of text in page order, and how often each path of elements opens."""
    blocks: list[Block] = []
    opened: Counter = Counter()
    stack: list[_Open] = []
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                main = bool(stack) and stack[-1].main
                other = bool(stack) and stack[-1].other
                inner = bool(stack) and stack[-1].inner
                blocks.append(Block("/".join(e.label for e in stack), text, main, other, inner))

    for token in _TOKENS.finditer(page):
        text, name = token[5], token[3]
        if text is not None:
            pieces.append(text)
            continue
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            pieces.append(" ")
            continue
        if token[2]:
            if name in _BLOCK or any(e.name == name for e in stack):
                if name in _BLOCK:
                    flush()
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth].name == name:
                        flush()
                        del stack[depth:]
                        break
            continue
        block = name in _BLOCK
        label, other = _roles(token[4]) if token[4] else ("", False)
        if name in _HEADINGS or name in _WHOLE:
            other = False
        if block:
            flush()
            while stack and stack[-1].name in _ENDED_BY_BLOCK:
                stack.pop()
            if name in _ENDED_BY_SAME and stack and stack[-1].name == name:
                stack.pop()
        other = other or name in OTHER_ELEMENTS
        if name in _VOID or not (block or other):
            continue
        if not block:
            flush()
        above = stack[-1] if stack else None
        outermost = name in _MAIN and not (above is not None and above.main)
        stack.append(
            _Open(
                name,
                name + label,
                name in _MAIN or above is not None and above.main,
                other or above is not None and above.other,
                not outermost and (other or above is not None and above.inner),
            )
        )
        opened["/".join(e.label for e in stack)] += 1
    flush()
    return blocks, opened


def _number(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _slot(path: str) -> str:
    """The path of the element that holds a block, without the block's own element."""
    return path.rpartition("/")[0]


def page_tokens(pages: DataFrame) -> DataFrame:
    """A row per host and token: its occurrence vector in three sums, its characters, its kind.

    Kinds: ``element``, ``text`` (a block with its path; ``slot`` is the number of the element that
    holds it) and ``slot`` (where text that is of no other role stands).  Characters of blocks of
    another role are not counted.
    """
    modulus = 1 << 62

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            found: dict = defaultdict(lambda: [0, 0, 0, 0, 1 << 62, -(1 << 62)])
            slots: dict = {}
            for host, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                blocks, opened = parse(page or "")
                own = xxhash.xxh64_intdigest("\n".join(b.text for b in blocks)) % modulus
                once: dict = defaultdict(lambda: [0, 0])
                for path, n in opened.items():
                    once["element", _number(path)][0] += n
                for block in blocks:
                    name = _number(f"{block.path}\n{block.text}")
                    held = _number(_slot(block.path))
                    slots[name] = held
                    chars = 0 if block.other else len(block.text)
                    places = [once["text", name]] + ([] if block.other else [once["slot", held]])
                    for place in places:
                        place[0] += 1
                        place[1] += chars
                for (kind, name), (n, chars) in once.items():
                    row = found[host, kind, name]
                    row[0] += 1
                    row[1] += n
                    row[2] = (row[2] + own * n) % modulus
                    row[3] += chars
                    row[4] = min(row[4], own)
                    row[5] = max(row[5], own)
            keys, sums = list(zip(*found, strict=True)), list(zip(*found.values(), strict=True))
            counts = ("n_pages", "n_times", "vector", "chars", "first_page", "last_page")
            yield (
                dict(zip(("host", "kind", "token"), keys or [[]] * 3, strict=True))
                | dict(zip(counts, sums or [[]] * 6, strict=True))
                | {"slot": [slots[name] if kind == "text" else 0 for _, kind, name in found]}
            )

    rows = map_batches(
        pages.select("host", "html"),
        "host string, kind string, token bigint, slot bigint, n_pages bigint, n_times bigint,"
        " vector bigint, chars bigint, first_page bigint, last_page bigint",
        work,
    )
    return rows.groupBy("host", "kind", "token").agg(
        F.min("slot").alias("slot"),
        F.sum("n_pages").alias("n_pages"),
        F.sum("n_times").alias("n_times"),
        F.expr(f"sum(cast(vector as decimal(38,0))) % {modulus}").alias("vector"),
        F.sum("chars").alias("chars"),
        F.min("first_page").alias("first_page"),
        F.max("last_page").alias("last_page"),
    )


def templates(pages: DataFrame, staging: Staging) -> DataFrame:
    """Per host with enough pages: ``constants`` (numbers of its templates' blocks of text),
    ``slots`` and ``weights`` (numbers of the slots and what they weigh, in one order), the number of
    valid ``n_classes`` and of ``n_entries``.

    What is collected per host is bounded by 100 times the tokens of its average page: a token is in
    ``PAGE_PERCENT`` of the pages at least.
    """
    tokens = staging.table(page_tokens(pages))
    hosts = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    frequent = (
        tokens.filter(F.col("n_pages") >= LEAST_PAGES)
        .join(hosts, "host")
        .filter(100 * F.col("n_pages") >= PAGE_PERCENT * F.col("host_pages"))
        .filter(F.col("first_page") != F.col("last_page"))
        .drop("host_pages")
    )
    vector = ["host", "n_pages", "n_times", "vector"]
    classes = (
        frequent.filter(F.col("kind") != "slot")
        .groupBy(*vector)
        .agg(
            F.count("*").alias("n_tokens"),
            F.count_if(F.col("kind") == "element").alias("n_elements"),
            F.collect_list(
                F.when(F.col("kind") == "text", F.struct("token", "slot", "chars"))
            ).alias("texts"),
        )
        .filter((F.col("n_tokens") >= LEAST_TOKENS) & (F.col("n_elements") > 0))
    )
    # Written once: read for the constants and for what the slots hold without them.
    valid = staging.table(classes.select("host", "texts"))
    constants = valid.groupBy("host").agg(
        F.array_sort(F.flatten(F.collect_list("texts.token"))).alias("constants"),
        F.count("*").alias("n_classes"),
    )
    fixed = (
        valid.select("host", F.explode("texts").alias("text"))
        .groupBy("host", F.col("text.slot").alias("token"))
        .agg(F.sum("text.chars").alias("fixed"))
    )
    remaining = F.col("chars") - F.coalesce("fixed", F.lit(0))
    slots = (
        frequent.filter(F.col("kind") == "slot")
        .join(fixed, ["host", "token"], "left")
        .groupBy("host")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("token", (remaining / F.col("n_pages")).alias("weight")))
            ).alias("found")
        )
        .select(
            "host", F.col("found.token").alias("slots"), F.col("found.weight").alias("weights")
        )
    )
    return constants.join(slots, "host", "full").withColumn(
        "n_entries",
        F.coalesce(F.size("constants"), F.lit(0)) + F.coalesce(F.size("slots"), F.lit(0)),
    )


def _heaviest(weights: dict[str, float]) -> str:
    """The element that the nesting leads to: down from the whole page to the element below that
    holds more than half of the weight, as long as there is one."""
    place = ""
    while True:
        below: Counter = Counter()
        total = 0.0
        start = len(place) + 1 if place else 0
        for path, weight in weights.items():
            if not place or f"{path}/".startswith(f"{place}/"):
                total += weight
                label = path[start:].partition("/")[0]
                if label:
                    below[label] += weight
        label = max(below, key=lambda name: (below[name], name), default="")
        if not label or 2 * below[label] <= total:
            return place
        place = f"{place}/{label}" if place else label


def extract(
    page: str, constants: frozenset[int], slots: dict[int, float] | None = None
) -> str:
    """The main text of one page under its host's template: its constants, its slots' weights.

    A slot that the template does not have weighs what it holds here.  Where every article, or what
    is around it, has another role, these roles do not count if the articles hold more text than all
    that has no other role.
    """
    found = parse(page)[0]
    blocks = [b for b in found if not b.other]
    inside = [b for b in blocks if b.main]
    if not inside:
        articles = [b for b in found if b.main and not b.inner]
        if sum(len(b.text) for b in articles) > sum(len(b.text) for b in blocks):
            inside = articles
    outside = [b for b in blocks if not b.main]
    if outside and (slots or not inside):
        weights = _weights(outside, slots)
        place = _heaviest(weights)
        held = [b for b in outside if not place or f"{b.path}/".startswith(f"{place}/")]
        kept = [b for b in held if _number(f"{b.path}\n{b.text}") not in constants]
        weight = sum(_weights(held, slots).values())
        if not inside or kept and weight > sum(_weights(inside, slots).values()):
            inside = kept
    return "\n".join(b.text for b in inside)


def _weights(blocks: list[Block], slots: dict[int, float] | None) -> dict[str, float]:
    """The slots of these blocks with their weights."""
    sizes: Counter = Counter()
    for block in blocks:
        sizes[_slot(block.path)] += len(block.text)
    return {path: (slots or {}).get(_number(path), size) for path, size in sizes.items()}


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id``, ``url``, ``html``).

    Character references are decoded, white space in a block becomes one space, blocks are trimmed
    and joined by one line feed; a heading inside the article is a block of it, and a line break is
    white space.  A null or empty page gives an empty text.  Pages without a host in their url
    share the host ''.  Rows that repeat are answered each; other columns are ignored.

    The templates are broadcast when their counted entries are at most ``BROADCAST_ENTRIES``;
    beyond that pages join them by host, salted, so a host with a third of all pages is spread.
    """
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^[a-z]+://([^/?#:]+)", 1)
    pages = pages.select("page_id", "url", "html", host.alias("host"))
    staging = Staging(pages.sparkSession)
    table, seen = staging.measured_table(
        templates(pages, staging), entries="sum(n_entries)"
    )
    if (seen["entries"] or 0) <= BROADCAST_ENTRIES:
        joined = pages.join(F.broadcast(table), "host", "left")
    else:
        salt = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
        salted = pages.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
        joined = salted.join(table.select("*", salt.alias("salt")), ["host", "salt"], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = zip(*(batch.column(i) for i in (2, 3, 4, 5)), strict=True)
            texts = [
                extract(
                    page.as_py() or "",
                    frozenset(known.as_py() or ()),
                    dict(zip(slots.as_py() or (), weights.as_py() or (), strict=True)),
                )
                for page, known, slots, weights in rows
            ]
            yield {
                "page_id": batch.column(0),
                "url": batch.column(1),
                "text": texts,
                "n_chars": [len(t) for t in texts],
            }

    return map_batches(
        joined.select("page_id", "url", "html", "constants", "slots", "weights"),
        "page_id bigint, url string, text string, n_chars bigint",
        work,
    )
