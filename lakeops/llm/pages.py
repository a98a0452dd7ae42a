"""Main text of web pages by markup and by a suffix array of each host.

Markup names most of what is not the article (menus, headers, footers, sidebars, forms, adverts,
comments) and often the article itself. All that stands outside it is compared over the pages of every
host: their token streams are laid end to end, a suffix array finds long substrings that occur on several
pages of different content, and of open blocks only the runs outside such substrings stay. What
stays is the page's own text, which is then weighed against marked parts that may be mere teasers.
"""

from __future__ import annotations

import hashlib
import html as entities
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import kept_table

MIN_TOKENS = 8
# Different contents of a host that hold a run which is no page's own: a quoted sentence or the
# print and mobile copies of an article stand on fewer.
MIN_CONTENTS = 4
# Bytes of pages whose streams share one suffix array; a host with more is split into shards, which
# exchange hashes of the windows they hold.
SHARD_BYTES = 16 << 20
MAX_BROADCAST_HOSTS = 100_000
# Tasks among which shards are dealt at most, and windows whose contents a task keeps in mind.
MAX_TASKS = 10_000
MAX_WINDOWS = 100_000

# Elements that hold no article text, and elements that break text into blocks.
DROPPED = frozenset("nav footer aside form button select textarea dialog iframe noscript template svg head title script style object menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body br button caption dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg textarea title iframe".split())
# Words in a class, id or role that mark what is not the article, and words beside
# them that say it is the article after all.
CHROME = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs header footer sidebar aside notice cookie cookies consent gdpr popup modal newsletter subscribe signup login share sharing "
    "social comment comments reply replies respond related recommended widget toolbar pagination pager copyright contentinfo "
    "complementary search alert dialog hidden".split()
)
ARTICLE_WORDS = frozenset("article post entry content story main body text".split())
# Of them the words that name no part of an article even inside one, and such roles.
FOREIGN = frozenset(
    "ad ads advert adverts advertisement advertising newsletter comment comments gdpr breadcrumb breadcrumbs pagination sidebar cookie "
    "cookies consent sponsor sponsored promo popup modal subscribe share sharing social widget".split()
)
# Words beside "related" or "recommended" that make a list of other articles of it.
OTHERS = frozenset("related recommended links posts articles stories content reading box list items".split())
FOREIGN_ROLES = frozenset("navigation search contentinfo complementary dialog".split())

# Words in the class of an article that only points to one.
TEASER = frozenset("card teaser tile preview".split())

TAG = re.compile(r"<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)", re.IGNORECASE)
# One attribute: a name, which may hold stray quotes, and a value in quotes or up to white space.
ATTRIBUTE = re.compile(
    r"[\s/]*+(?:(?P<key>[^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"(?P<a>[^\"]*+)\"|'(?P<b>[^']*+)'|(?P<c>[^\s>\"'][^\s>]*+)|(?=>)))?+)?+"
)
MAIN, OPEN, OUTSIDE, TEASERS = 0, 1, 2, 3
# Odd factors of the two window hashes.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def _tokens(page: str) -> Iterator[tuple[str, bool, dict[str, str] | None, str]]:
    """Tags as (name, end tag, attributes, "") and texts as ("", False, None, text), in time linear in the page.

    Comments, declarations and the contents of raw elements are left out. A value without quotes ends at
    white space or ``>``, and a quote elsewhere is part of a name. Where an open quote would
    swallow the rest of the page, tags end at their first ``>``; a ``<`` no ``>`` follows is text.
    """
    at, n, last, loose = 0, len(page), page.rfind(">"), False
    while at < n:
        begin = page.find("<", at)
        begin = n if begin < 0 else begin
        if begin > at:
            yield "", False, None, page[at:begin]
        if begin == n:
            return
        if begin > last:
            yield "", False, None, page[begin:]
            return
        tag = TAG.match(page, begin)
        if not tag:
            at = _skipped(page, begin)
            if at == begin:
                yield "", False, None, "<"
                at += 1
            continue
        name = tag["name"].lower()
        attributes, at = _attributes(page, tag.end())
        if at < 0 or loose:
            loose, at = True, page.find(">", begin) + 1
            if attributes and at > 0:
                attributes = _attributes(page[tag.end() : at], 0)[0]
        yield name, bool(tag["end"]), attributes, ""
        if name in RAW and not tag["end"]:
            close = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = page.find(">", close.end()) + 1 if close else n
            at = at or n
            yield name, True, {}, ""


def _skipped(page: str, at: int) -> int:
    """End of a comment or declaration, or ``at`` where a ``<`` begins none."""
    for begin, end in (("<!--", "-->"), ("<![CDATA[", "]]>")):
        if page.startswith(begin, at):
            found = page.find(end, at + len(begin))
            return len(page) if found < 0 else found + len(end)
    if page[at + 1 : at + 2] in ("/", "!", "?"):
        return page.find(">", at) + 1
    return at


def _attributes(page: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes that say what an element is, the first of each name, and the tag's end (-1: none)."""
    out: dict[str, str] = {}
    while True:
        found = ATTRIBUTE.match(page, at)
        at = found.end()
        if found["key"] is None:
            return out, at + 1 if page.startswith(">", at) else -1
        key = found["key"].lower()
        if key in ("class", "id", "role", "hidden"):
            out.setdefault(key, (found["a"] or found["b"] or found["c"] or "").lower())


def _marked(name: str, attributes: dict[str, str], inside: bool) -> tuple[bool, bool, bool]:
    """Whether an element is chrome by its attributes, says it is the main part, or only points to an article.

    Only attributes of these very names count, never words in other attributes. Inside the main part
    an element is chrome only by words that name nothing of an article.
    """
    chrome = main = teaser = False
    for key, value in attributes.items():
        words = set(re.split(r"[^a-z]+", value))
        if key == "hidden":
            chrome = chrome or value in ("", "hidden")
        elif key == "role" and value == "main":
            main = True
        elif inside:
            others = words & {"related", "recommended"} and words - {""} <= OTHERS
            chrome = chrome or bool(value in FOREIGN_ROLES if key == "role" else words & FOREIGN or others)
        elif words & CHROME and (not words & ARTICLE_WORDS or words & {"comment", "comments", "ad", "ads", "advert"}):
            chrome = name not in ("html", "body", "main")
        teaser = teaser or (key == "class" and bool(words & TEASER))
    return chrome, main, teaser


def parse(page: str) -> tuple[list[str], list[int], list[str]]:
    """Blocks of a page, the zone of each, and the page's token stream outside its main part."""
    blocks, zones, stream, parts, teasers = _parse(page)
    if teasers:
        chosen = _by_share(_kinds(zones, parts, teasers), list(map(len, blocks)), teasers)
        zones = [zone if kept else OUTSIDE for zone, kept in zip(zones, chosen)]
    return blocks, zones, stream


def _parse(page: str) -> tuple[list[str], list[int], list[str], list[int], list[bool]]:
    """The same before marked parts are weighed, the number of each block's marked part, and which parts are teasers.

    The stream has tags and words; a block's words follow ``#``, a space and the block's number, which no word can be.
    """
    blocks: list[str] = []
    zones: list[int] = []
    parts: list[int] = []  # of each block in a main part its number
    stream: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, dropped, main part
    opened: dict[str, int] = {}
    teasers: list[bool] = []  # of each main part, whether it only points to an article
    dropped = inside = 0
    held: list[str] = []

    def close() -> None:
        if not held:
            return
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            blocks.append(text)
            zones.append(OUTSIDE if dropped else MAIN if inside else OPEN)
            parts.append(len(teasers) - 1)
            if dropped or not inside:
                stream.append(f"# {len(blocks) - 1}")
                stream.extend(text.split(" "))

    def pop(to: int) -> None:
        nonlocal dropped, inside
        for name, bad, good in stack[to:]:
            dropped -= bad
            inside -= good
            opened[name] -= 1
        del stack[to:]

    for name, ends, attributes, text in _tokens(page):
        if attributes is None:
            held.append(text)
            continue
        if name in BLOCKS:
            close()
        if ends:
            if opened.get(name):  # else nothing to end: the stack is not searched
                at = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name)
                if name not in BLOCKS and stack[at][1]:
                    close()  # the text of a dropped element that breaks no block
                pop(at)
        elif name not in VOID:
            if name in ("p", "li", "option") and any(s[0] == name for s in stack[-3:]):
                at = max(i for i in range(max(0, len(stack) - 3), len(stack)) if stack[i][0] == name)
                if all(s[0] not in BLOCKS for s in stack[at + 1 :]):
                    pop(at)  # its end tag was left out
            chrome, main, teaser = _marked(name, attributes, inside > 0)
            bad = chrome or name in DROPPED or (name == "header" and not inside)
            good = (main or name in ("article", "main")) and not bad and not dropped
            if bad and name not in BLOCKS:
                close()
            if good and not inside:
                teasers.append(teaser and name == "article")
            stack.append((name, bad, good))
            opened[name] = opened.get(name, 0) + 1
            dropped += bad
            inside += good
        if dropped or not inside:
            stream.append(f"<{'/' * ends}{name}>")
    close()
    return blocks, zones, stream, parts, teasers


def _kinds(zones: list[int], parts: list[int], teasers: list[bool]) -> list[int]:
    """Of each block ``OUTSIDE``, ``OPEN``, ``MAIN``, or ``TEASERS`` in a main part that only points to an article."""
    return [TEASERS if zone == MAIN and teasers[part] else zone for zone, part in zip(zones, parts)]


def _by_share(kinds: list[int], sizes: list[int], teasers: list[bool]) -> list[bool]:
    """Which blocks of a page with marked parts are its text, by the sizes of what stays of them.

    Main parts are the article, and open text beside them is not, unless they are teasers: by their class,
    or as several that hold less text than what is open. Teasers are the text only of a page that has
    no other, or less.
    """
    size = dict.fromkeys((MAIN, OPEN, TEASERS, OUTSIDE), 0)
    for kind, chars in zip(kinds, sizes):
        size[kind] += chars
    if False in teasers:
        mine = teasers.count(False) < 2 or size[MAIN] >= size[OPEN]
        chosen = MAIN if mine else OPEN
    else:
        chosen = TEASERS if size[TEASERS] > size[OPEN] else OPEN
    return [kind == chosen for kind in kinds]


def _content(blocks: list[str]) -> bytes:
    """The same for pages with the same words, whatever their markup."""
    return hashlib.blake2b(" ".join(blocks).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _pages(batches: Iterator[pa.RecordBatch], read: Callable = parse) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of batches with the parsed pages of each."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            yield rows, [read(page) for page in rows.column("html").to_pylist()]


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every page its content, whether markup leaves its text open, and its size."""
    for rows, parsed in _pages(batches, _parse):
        sizes = rows.column("html").cast(pa.large_binary()).to_pylist()
        still = []  # whether by the blocks as they stand open text is the page's
        for blocks, zones, _, parts, teasers in parsed:
            kinds = _kinds(zones, parts, teasers)
            chosen = _by_share(kinds, list(map(len, blocks)), teasers) if teasers else [True] * len(kinds)
            still.append(any(c and k == OPEN for c, k in zip(chosen, kinds)))
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("host"),
                pa.array([_content(page[0]) for page in parsed], pa.binary()),
                pa.array(still, pa.bool_()),
                pa.array(list(map(len, sizes)), pa.int64()),
            ],
            ["host", "content", "open", "bytes"],
        )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parsed pages: their blocks, of each its kind, which marked parts are teasers, and the stream by lines."""
    for rows, parsed in _pages(batches, _parse):
        kinds = [_kinds(zones, parts, teasers) for _, zones, _, parts, teasers in parsed]
        blocks = [["" if k == OUTSIDE else b for b, k in zip(page[0], held)] for page, held in zip(parsed, kinds)]
        yield pa.RecordBatch.from_arrays(
            [
                *(rows.column(c) for c in ("page_id", "url", "host")),
                pa.array([_content(page[0]) for page in parsed], pa.binary()),
                pa.array(blocks, pa.list_(pa.string())),
                pa.array(kinds, pa.list_(pa.int32())),
                pa.array([page[4] for page in parsed], pa.list_(pa.bool_())),
                pa.array(["\n".join(page[2]) for page in parsed], pa.string()),  # no token has white space but a mark's
            ],
            ["page_id", "url", "host", "content", "blocks", "kinds", "teasers", "stream"],
        )


def _is_word(token: str) -> bool:
    """Whether a token of a stream is one of the page: block marks only say which block follows."""
    return not token.startswith("# ")


def _token_hashes(tokens: list[str]) -> np.ndarray:
    """Two 64-bit hashes of each token."""
    joined = b"".join(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in tokens)
    return np.frombuffer(joined, "<u8").reshape(-1, 2).astype(np.uint64)


def _window_hashes(tokens: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Two 64-bit hashes of the ``length`` tokens from each start on."""
    out = np.zeros((len(starts), 2), np.uint64)
    for k in range(length):
        out = out * FACTORS + tokens[starts + k]
    return out.astype(np.int64)


def _windows(min_tokens: int):
    """Hashes of the windows of every page with its content; a task tells of a window no more contents than needed, and each shard."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: dict[tuple, tuple[set[bytes], set[int]]] = {}
        for rows, parsed in _pages(batches):
            places = list(zip(*(rows.column(c).to_pylist() for c in ("host", "shard", "needed"))))
            at, contents, found = [], [], []
            for i, (blocks, _, stream) in enumerate(parsed):
                tokens = [t for t in stream if _is_word(t)]
                n = len(tokens) - min_tokens + 1
                if n <= 0:
                    continue
                content = _content(blocks)
                hashes = np.unique(_window_hashes(_token_hashes(tokens), np.arange(n), min_tokens), axis=0)
                host, shard, needed = places[i]
                for h1, h2 in hashes.tolist():
                    held, shards = told.setdefault((host, h1, h2), (set(), set()))
                    if shard not in shards or (len(held) < needed and content not in held):
                        held.add(content)
                        shards.add(shard)
                        at.append(i)
                        contents.append(content)
                        found.append((h1, h2))
                if len(told) > MAX_WINDOWS:
                    told.clear()
            if at:
                of = rows.take(pa.array(at, pa.int64()))
                hashes = np.array(found, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(of.column(c) for c in ("host", "shard", "needed")), pa.array(contents, pa.binary()), *(pa.array(hashes[:, j]) for j in (0, 1))],
                    ["host", "shard", "needed", "content", "h1", "h2"],
                )

    return windows


def _known_windows(dealt: DataFrame, min_tokens: int) -> DataFrame:
    """For each shard of a host those of its windows that enough contents of the whole host hold.

    A window of a hot host is counted in two steps: each content once, then partial counts.
    """
    found = dealt.mapInArrow(
        _windows(min_tokens), "host string, shard int, needed int, content binary, h1 long, h2 long"
    )
    several = (
        found.groupBy("host", "h1", "h2", "needed", "content")
        .agg(F.collect_set("shard").alias("shards"))
        .groupBy("host", "h1", "h2", "needed")
        .agg(F.count("*").alias("n"), F.array_distinct(F.flatten(F.collect_set("shards"))).alias("shards"))
        .where("n >= needed")
        .select("host", F.explode("shards").alias("shard"), "h1", "h2")
    )
    return several.groupBy("host", "shard").agg(F.collect_list(F.struct("h1", "h2")).alias("known"))


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all suffixes in their order, and the common prefix of each with the one before it (0 for the first).

    Ranks by the first 1, 2, 4, ... symbols are sorted until all suffixes differ. They are kept: two
    neighbours agree on the blocks of falling length whose ranks are equal. The last symbol has to be unique.
    """
    n, reach = len(symbols), 1
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    levels = []
    while n and rank.max() < n - 1:
        levels.append(rank.astype(np.int32))
        after = np.zeros(n, np.int64)
        after[: n - reach] = rank[reach:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        reach *= 2
    order = np.argsort(rank)
    common = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for k in reversed(range(len(levels))):
        # Suffixes that agree so far end in different symbols, so neither is at the end of the text.
        same = (levels[k][a] == levels[k][b]).astype(np.int64) << k
        a, b = a + same, b + same
        common[1:] += same
    return order, common


def shared_places(
    symbols: np.ndarray,
    page: np.ndarray,
    length: int,
    content: np.ndarray,
    needed: int,
    known: Callable[[np.ndarray], np.ndarray] | None = None,
) -> np.ndarray:
    """Places of pages' tokens inside substrings of ``length`` or more that pages of ``needed``
    different contents hold (``content`` has the number of each page's). Where other shards count
    too, ``known`` tells it of the substrings at given starts.

    Every page ends in a symbol of its own, so no common prefix crosses pages. In suffix order, neighbours with
    common prefixes of ``length`` or more are one group; of a group that enough contents hold, the places
    under its suffixes' first ``length`` tokens are shared, and longer runs are covered by their later suffixes.
    """
    if not len(symbols):
        return np.zeros(0, bool)
    at = np.arange(len(symbols)) + page  # one end behind each page before
    size = len(symbols) + len(content)
    text, owner = np.zeros(size, np.int64), np.zeros(size, np.int64)
    ends = np.ones(size, bool)
    ends[at] = False
    text[at], owner[at] = symbols, page
    text[ends] = symbols.max() + 1 + np.arange(len(content))
    left = np.minimum.accumulate(np.where(ends, np.arange(size), size)[::-1])[::-1] - np.arange(size)
    order, common = suffix_array(text)
    group = np.cumsum(common < length) - 1
    whole = left[order] >= length  # else alone in its group, as it runs into the end of its page
    order, group = order[whole], group[whole]
    if not len(order):
        return np.zeros(len(symbols), bool)
    _, first, group = np.unique(group, return_index=True, return_inverse=True)
    if known:
        starts = order[first]
        several = known(starts - owner[starts])
    else:
        held = np.unique(group * (len(content) + 1) + content[owner[order]])  # a content counts once
        several = np.bincount(held // (len(content) + 1)) >= needed
    starts = order[several[group]]
    marks = np.zeros(size + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + length, -1)
    return (np.cumsum(marks[:-1]) > 0)[at]


def _own_blocks(stream: list[str], shared: np.ndarray, blocks: list[str], kinds: list[int]) -> list[str]:
    """Blocks of a page, the open ones without the words at shared places of its stream."""
    own: list[list[str]] = [[] for _ in blocks]
    block, left = -1, 0
    for token, several in zip(stream, shared.tolist()):
        if not _is_word(token):
            block = int(token[2:])
            left = len(blocks[block].split(" ")) if kinds[block] == OPEN else 0
        elif left:
            left -= 1
            if not several:
                own[block].append(token)
    return [" ".join(o) if k == OPEN else b for o, b, k in zip(own, blocks, kinds)]


def _settle(min_tokens: int):
    """Text of every page of each shard of a host (rows come sorted by host and shard)."""

    def settle(rows: pa.Table) -> pa.RecordBatch:
        lists = rows.column("known")
        rows = rows.filter(rows.column("known").is_null())
        texts: list[str] = []
        if rows.num_rows:
            # Pages with equal streams are compared once.
            given: dict[tuple[bytes, str], int] = {}
            place = [given.setdefault(key, len(given)) for key in zip(rows.column("content").to_pylist(), rows.column("stream").to_pylist())]
            streams = [stream.split("\n") if stream else [] for _, stream in given]
            numbers: dict[bytes, int] = {}
            content = np.array([numbers.setdefault(c, len(numbers)) for c, _ in given], np.int64)
            known: dict[str, int] = {}
            symbols = np.array([known.setdefault(t, len(known)) for s in streams for t in s if _is_word(t)], np.int64)
            word = np.array([_is_word(t) for s in streams for t in s], bool)
            page = np.repeat(np.arange(len(streams)), [len(s) for s in streams])
            shared = np.zeros(len(word), bool)
            told = None
            if rows.column("shards")[0].as_py() > 1:
                pairs = lists.drop_null().combine_chunks().flatten()
                several = {*zip(pairs.field("h1").to_pylist(), pairs.field("h2").to_pylist())}
                hashes = _token_hashes(list(known))[symbols]

                def told(starts: np.ndarray) -> np.ndarray:
                    return np.array([(a, b) in several for a, b in _window_hashes(hashes, starts, min_tokens).tolist()], bool)

            shared[word] = shared_places(symbols, page[word], min_tokens, content, rows.column("needed")[0].as_py(), told)
            begins = np.append(0, np.cumsum([len(s) for s in streams])).tolist()
            for k, *own in zip(place, *(rows.column(c).to_pylist() for c in ("blocks", "kinds", "teasers"))):
                blocks, kinds, teasers = own
                here = shared[begins[k] : begins[k + 1]]
                stay = _own_blocks(streams[k], here, blocks, kinds) if OPEN in kinds and here.any() else blocks
                chosen = _by_share(kinds, list(map(len, stay)), teasers) if teasers else [True] * len(stay)
                texts.append(" ".join(b for b, c in zip(stay, chosen) if c and b))
        return pa.RecordBatch.from_arrays(
            [rows.column("page_id").combine_chunks(), rows.column("url").combine_chunks(), pa.array(texts, pa.string())],
            ["page_id", "url", "text"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            hosts, shards = batch.column("host").to_pylist(), batch.column("shard").to_pylist()
            at = 0
            for i in range(batch.num_rows):
                if (hosts[i], shards[i]) != key:
                    if i > at:
                        held.append(batch.slice(at, i - at))
                    if held:
                        yield settle(pa.Table.from_batches(held))
                    held, at, key = [], i, (hosts[i], shards[i])
            if batch.num_rows > at:
                held.append(batch.slice(at))
        if held:
            yield settle(pa.Table.from_batches(held))

    return run


def extract_main_text(
    pages: DataFrame,
    id_name: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_tokens: int = MIN_TOKENS,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``page_id``, ``url`` and ``text``: the article of every page.

    Character references are decoded, white space inside a block becomes one space, and blocks are
    joined by one space in page order. Where a page marks its article (``article``, ``main``), that
    part is the text, without what markup names as something else; several marked parts that hold less
    than the page's own open text, or are called cards or teasers, are not the article. What stands outside the
    article, on every page of every host, goes through the host's suffix array. Of open text, blocks
    stay but for runs of ``min_tokens`` or more tokens that stand on :data:`MIN_CONTENTS` different
    contents of the host. A host of fewer contents needs all that markup leaves open, and all but one
    of all; of two contents nothing can be told, so their open blocks stay whole.

    One row per input row; a null, empty or textless page has an empty text; null ids and urls stay
    null, and pages without a host form one host. Pages with the same words count as one content.
    An empty table gives an empty result; further columns are ignored. A host with more than
    ``shard_bytes`` is split into shards by page, each with its own suffix array, so no task takes a
    whole large host; what a run's contents are counted over is the whole host all the same.
    """
    source = pages.select(
        F.col(f"`{id_name}`").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"),
    ).withColumn("host", F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/?#]+)", 1)), F.lit("")))
    found = source.select("host", "html").mapInArrow(_contents, "host string, content binary, open boolean, bytes long")
    hosts = kept_table(
        found.groupBy("host", "content")
        .agg(F.max("open").alias("open"), F.sum("bytes").alias("bytes"))
        .groupBy("host")
        .agg(F.count("*").alias("total"), F.count_if("open").alias("open"), F.sum("bytes").alias("bytes"))
        .select(
            "host",
            F.when(F.col("total") > 2, F.least(F.lit(MIN_CONTENTS), F.greatest(F.lit(2), "open", F.col("total") - 1)))
            .otherwise(3)
            .cast("int")
            .alias("needed"),
            F.greatest(F.lit(1), F.ceil(F.col("bytes") / shard_bytes)).cast("int").alias("shards"),
            "bytes",
        ),
        "hosts",
    )
    n_hosts, n_bytes = hosts.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    hosts = hosts.drop("bytes")
    few = F.broadcast if n_hosts <= MAX_BROADCAST_HOSTS else lambda some: some  # else joined by shuffle
    kind = dict(source.dtypes)["page_id"]
    shard = F.pmod(F.xxhash64("page_id", "url"), "shards").cast("int")
    columns = (
        f"page_id {kind}, url string, host string, content binary, blocks array<string>, kinds array<int>, "
        "teasers array<boolean>, stream string"
    )
    together = (
        source.mapInArrow(_read, columns)
        .join(few(hosts), "host")
        .withColumn("shard", shard)
        .withColumn("known", F.lit(None).cast("array<struct<h1:long,h2:long>>"))
    )
    large = hosts.where("shards > 1")
    if not large.isEmpty():  # what a shard's array finds is counted over the host
        lists = _known_windows(source.join(few(large), "host").withColumn("shard", shard), min_tokens)
        together = together.unionByName(lists, allowMissingColumns=True)
    usual = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(usual, min(MAX_TASKS, 2 * math.ceil(n_bytes / shard_bytes)))
    settled = together.repartition(tasks, "host", "shard").sortWithinPartitions("host", "shard")
    return settled.mapInArrow(_settle(min_tokens), f"page_id {kind}, url string, text string")
