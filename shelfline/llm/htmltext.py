"""HTML main text, with suffix arrays over the host's token streams.

Each page is read into blocks. What the markup itself names as menu, header,
footer, sidebar, notice, advert, form, comment, script or style is cut, and
blocks inside an article (or main) element are its text. Blocks that are
neither are judged by the host, and so are those of an article that may be copies
of the host's menus and notices. Every page gives two token streams, of what stands
outside its articles and of its articles. Those of the different pages of every host
(pages of one text are one) are concatenated in shards of a bounded number of tokens,
each with a suffix array whose neighbours share their beginnings: every substring of
``MIN_RUN`` tokens, on how many pages it stands, and on how many outside the articles.
A page is in one shard, so the numbers of all shards add up to the host's, however it
is dealt. Pages of one text whose cut parts differ are one page with all these parts.
Substrings that stand outside the articles on ``TEMPLATE_PAGES`` pages or more that
are ``TEMPLATE_SHARE`` of the host's are its template: a loose block loses what they
cover at its ends. Any other substring on two pages or more, in their articles or
outside, only speaks against blocks that such substrings cover whole, and only if the
page keeps at least half of its text without them; otherwise the page is taken for
another copy of a text, which is not cut. Article text is not cut for standing in
several articles; a block of an article is only cut if the host's template covers it
whole and the page keeps at least half of its text without such blocks.

Substrings of different shards are told apart by 64-bit hashes of host and words and
added up by hash, so that no host meets in one task. They are as many as the words of
all pages, so they are exchanged in ``ROUNDS`` equal parts, one after the other, sorted
and without the bytes that neighbours share. An article's blocks ask for the template by
their first ``MIN_RUN`` tokens, and only pages with a block that begins like it are
compared with it in full.

Defined results: null or empty html has empty text; truncated and unclosed
markup is closed where the text ends or an article begins; a null url is a host
of its own; equal rows are one page to the host and each keep their text; an
empty table gives an empty one; only the named columns are read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm import words as W
from shelfline.llm.common import col, release, stage

MIN_RUN = 6          # tokens of a repeated substring
TEMPLATE_PAGES = 5   # different pages of a host that show a template at least
TEMPLATE_SHARE = 0.5

# Element and class names that mark what is not main text.
RAW = "script style noscript textarea title xmp".split()
CUT = ("head nav header footer aside form menu dialog button fieldset template svg math iframe object select option "
       "optgroup datalist").split()
BLOCK = ("address article aside blockquote body br canvas center dd details dir div dl dt fieldset figure footer form h1 h2 "
         "h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
         "thead title tr ul").split()
MARKS = ("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
         "disclaimer footer header masthead menu nav navbar navigation newsletter notice notices pagination popup promo "
         "promoted related replies share sharing sidebar signup social sponsor sponsored subscribe toolbar widget").split()
#: Words beside a mark in a name that say no more than where or how: "footer-links".
BESIDE = ("area articles bar block body bottom box button buttons col column container content form group holder icons inner item items "
          "label left link links list message modal outer overlay page panel posts primary right row secondary section site slot "
          "stories text title top unit wrap wrapper").split()
#: Before a mark these turn it round: "no-sidebar" is not a sidebar.
WITHOUT = "has hide is no on with without".split()
WHOLE = "html body".split()     # a page's own names say nothing against its text
VOID = "area base br col embed hr img input link meta source track wbr".split()

# a quote opens a value only after "=": anywhere else it is a character like others
_PART = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*+)"
                   r"((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|))*+)(?:>|\Z)", re.DOTALL)
_NAMED = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
_ARTICLE = re.compile(r"<(?:article|main)\b", re.IGNORECASE)
_WORDS = re.compile(r"[^A-Za-z]+")
_RAW, _CUT, _BLOCK, _MARKS, _VOID, _BESIDE, _WITHOUT, _WHOLE = map(frozenset, (RAW, CUT, BLOCK, MARKS, VOID, BESIDE, WITHOUT, WHOLE))
ARTICLE, LOOSE, OUT = 0, 1, 2
_BASE = 0x9E3779B97F4A7C15
_PAGES = 100        # pages whose windows are put out at once
SHARD_TOKENS = 1 << 19      # tokens of a suffix array, or one longer page
ROUNDS = 3                  # parts in which the substrings of all shards are exchanged
ROUND_TOKENS = 1 << 22      # tokens of all pages for each round: small tables take fewer
BUCKET_TOKENS = 1 << 21     # about as many substrings are added up at once
_LOW = 48                   # bits of a substring's hash that are exchanged; the others are counted
_PACKED = "bucket int, low binary, begun binary, few array<long>, pages array<long>, outside array<long>"
_PACKED_NAMES = [x.split()[0] for x in _PACKED.split(", ")]


def _names_mark(name: str) -> bool:
    """Whether one class, id or role names a part that is not main text: a mark, or
    words that end in one ("cookie-notice"), or marks with words that only say
    where ("footer-links"); not a name that has one for its subject
    ("comments-on-the-law")."""
    words = [w for w in _WORDS.split(name.lower()) if w]
    if not words or words[0] in _WITHOUT:
        return False
    return words[-1] in _MARKS or (words[0] in _MARKS and all(w in _MARKS or w in _BESIDE for w in words))


def _marked(name: str, attributes: str) -> bool:
    if name in _WHOLE:
        return False
    if _HIDDEN.search(attributes):
        return True
    return any(_names_mark(x) for m in _NAMED.finditer(attributes) for x in "".join(v or "" for v in m.groups()[1:]).split())


def _closed(page: str) -> set[int]:
    """Where the elements begin that are closed by a tag of their own."""
    open_: dict[str, list[int]] = {}
    order: list[tuple[str, int]] = []
    out: set[int] = set()
    at = 0
    while m := _PART.search(page, at):
        at = m.end()
        if not m[2] or (name := m[2].lower()) in _VOID or m[3].endswith("/"):
            continue
        if m[1]:
            if open_.get(name):
                start = open_[name].pop()
                out.add(start)
                while order and order[-1][1] >= start:      # what was open inside ends with it
                    inner, where = order.pop()
                    if where > start:
                        open_[inner].pop()
        elif name in _RAW:
            end = re.compile(rf"</{name}\b", re.IGNORECASE).search(page, at)
            at = end.start() if end else at
        else:
            open_.setdefault(name, []).append(m.start())
            order.append((name, m.start()))
    return out


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of the page's blocks that are not empty, in page order. An
    article that lies whole in a cut element is cut with it (a teaser, a reader's
    comment), unless the page has no other text; one that begins in a cut element
    which is never closed ends it."""
    out = _blocks(page or "", True)
    if any(k != OUT for k, _ in out) or not out or not _ARTICLE.search(page or ""):
        return out
    return _blocks(page, False)


def _blocks(page: str, teasers_cut: bool) -> list[tuple[int, str]]:
    out: list[tuple[int, str]] = []
    held: list[str] = []
    open_: list[tuple[str, bool, int]] = []   # open elements that are blocks or cut, whether they cut, where they began
    cut = inside = at = 0
    closed: set[int] | None = None

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((OUT if cut else ARTICLE if inside else LOOSE, text))

    while at < len(page):
        m = _PART.search(page, at)
        held.append(page[at:m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in _BLOCK or name in _CUT or name in _RAW:
            flush()
        if closing:
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == name:
                    flush()
                    for was, cuts, _ in open_[i:]:
                        cut -= cuts
                        inside -= was in ("article", "main")
                    del open_[i:]
                    break
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            if end:
                at = end.end()
            else:   # unclosed: ends where an article begins
                end = _ARTICLE.search(page, at)
                at = end.start() if end else len(page)
            continue
        if name in ("article", "main") and not inside:
            if cut and teasers_cut:
                closed = _closed(page) if closed is None else closed
            if not cut or not teasers_cut or not any(cuts and start in closed for _, cuts, start in open_):
                open_, cut = [], 0      # ends what was left open
        marked = name not in _VOID and (name in _CUT or _marked(name, m[3]))
        if marked and name == "header" and inside:
            marked = _marked(name, m[3])  # an article's own head
        if name in _VOID or m[3].endswith("/"):
            continue
        if marked or name in _BLOCK:
            flush()
            if name in ("p", "li", "option") and open_ and open_[-1][0] == name:  # closed by its like
                cut -= open_.pop()[1]
            open_.append((name, marked, m.start()))
            cut += marked
            inside += name in ("article", "main")
    flush()
    return out


def _order(tokens: np.ndarray, stream: np.ndarray, least: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen suffixes of a concatenation of streams (a suffix ends with its
    stream) sorted by their first ``least`` tokens, then by place, and which of them
    begin otherwise than the one before: the suffix array, as deep as needed. Ranks
    of the suffixes by their first tokens are made from those by fewer, as many of
    them at once as go into 63 bits."""
    n = len(tokens)
    _, rank = np.unique(tokens, return_inverse=True)
    have = 1
    while True:
        width = (int(rank.max()) + 1).bit_length()
        parts = min(62 // width, -(-least // have))
        cover = min(parts * have, least)
        at = chosen if cover == least else np.arange(n)
        key = np.zeros(len(at), np.int64)
        for i in range(parts):
            to = at + min(i * have, cover - have)
            end = np.minimum(to, n - 1)
            key = (key << width) | np.where((to < n) & (stream[end] == stream[at]), rank[end] + 1, 0)
        if cover == least:
            order = np.argsort(key, kind="stable")
            key = key[order]
            return at[order], np.concatenate([[True], key[1:] != key[:-1]])[:len(key)]
        _, rank = np.unique(key, return_inverse=True)
        have = cover


def repeats(tokens: np.ndarray, page: np.ndarray, least: int = MIN_RUN, stream: np.ndarray | None = None,
            chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different substrings of ``least`` tokens inside the streams of pages (by
    default one a page) that begin at chosen positions (all), from the suffix array: for each
    position its substring's number (-1: not chosen, or too near to its stream's end),
    and for each substring a position and the number of pages it stands on."""
    n, stream = len(tokens), page if stream is None else stream
    which = np.full(n, -1)
    whole = np.flatnonzero(stream[:n - least + 1] == stream[least - 1:]) if n >= least else np.zeros(0, np.int64)
    if chosen is not None:
        whole = whole[chosen[whole]]
    if not len(whole):
        return which, np.zeros(0, np.int64), np.zeros(0, np.int64)
    order, new = _order(tokens, stream, least, whole)       # neighbours share their beginnings
    p = page[order]
    other = new | np.concatenate([[True], p[1:] != p[:-1]])
    start = np.flatnonzero(new)
    which[order] = np.cumsum(new) - 1
    return which, order[start], np.add.reduceat(other.astype(np.int64), start)


def covered(tokens: np.ndarray, page: np.ndarray, least: int = MIN_RUN) -> np.ndarray:
    """Which tokens lie in a substring of ``least`` tokens or more that occurs
    on two pages."""
    which, _, pages = repeats(tokens, page, least)
    hit = np.concatenate([pages > 1, [False]])[which]
    edge = np.zeros(len(tokens) + least, np.int64)
    edge[:len(tokens)] += hit
    edge[least:] -= hit
    return np.cumsum(edge[:len(tokens)]) > 0


def _salt(hosts: list[str]) -> np.ndarray:
    """What tells substrings of different hosts apart."""
    each = {h: xxhash.xxh64_intdigest(h) for h in dict.fromkeys(hosts)}
    return W.mixed(np.array([each[h] for h in hosts], np.uint64))


def _bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    """Bucket of each key: its first bits."""
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def packed(keys: np.ndarray, pages: np.ndarray, outside: np.ndarray, bits: int) -> pa.RecordBatch:
    """Different keys with their numbers of pages, as a row a bucket. Those on one
    page, in its articles only, are nearly all: sorted, without the numbers, and of their 64
    bits only the last 48, with how many of them begin with each 16 bits."""
    order = np.argsort(keys)
    keys, pages, outside = keys[order], pages[order], outside[order]
    lone = (pages == 1) & (outside == 0)
    some, few = keys[lone], keys[~lone]
    begun = np.bincount((some >> np.uint64(_LOW)).astype(np.int64), minlength=1 << 16).astype("<u2")
    n, n_few = (np.bincount(_bucket(x, bits), minlength=1 << bits) for x in (some, few))
    wide = (2 << 16 - bits) * (n > 0)
    begun = begun.reshape(1 << bits, -1)[n > 0]
    low = np.ascontiguousarray(some.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_LOW // 8])
    here = np.flatnonzero(n + n_few)

    def offsets(sizes: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(sizes[here])]).astype(np.int32)

    def binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(here), [None, pa.py_buffer(offsets(sizes).tobytes()), pa.py_buffer(data.tobytes())])

    def lists(data: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(offsets(n_few)), pa.array(data.view(np.int64)))

    return pa.RecordBatch.from_arrays(
        [pa.array(here.astype(np.int32)), binary(low, n * (_LOW // 8)), binary(begun, wide), lists(few), lists(pages[~lone]), lists(outside[~lone])],
        _PACKED_NAMES)


def added_up(rows: pa.Table, bits: int) -> pa.Table:
    """The keys of one bucket that stand on two pages or more, with the numbers of
    all its rows added up."""
    low = np.frombuffer(b"".join(rows["low"].to_pylist()), np.uint8).reshape(-1, _LOW // 8)
    begun = np.frombuffer(b"".join(rows["begun"].to_pylist()), "<u2").reshape(-1, 1 << 16 - bits)
    lone = np.zeros((len(low), 8), np.uint8)
    lone[:, :_LOW // 8] = low
    lone = lone.view("<u8").ravel()
    first = (rows["bucket"][0].as_py() << 16 - bits) + np.tile(np.arange(1 << 16 - bits), len(begun))
    lone |= np.repeat(first, begun.ravel()).astype(np.uint64) << np.uint64(_LOW)
    few, pages, outside = (np.concatenate([np.zeros(0, np.int64), *[x.values.to_numpy()[x.offsets[0].as_py():x.offsets[-1].as_py()] for x in rows[c].chunks]])
                           for c in ("few", "pages", "outside"))
    keys = np.concatenate([lone, few.view(np.uint64)])
    order = np.argsort(keys)
    keys = keys[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    pages, outside = (np.add.reduceat(np.concatenate([np.full(len(lone), one), x])[order], start) for one, x in ((1, pages), (0, outside)))
    many = pages > 1
    return pa.table({"window": keys[start][many].view(np.int64), "pages": pages[many], "outside": outside[many]})


def shard(hosts: list[str], streams: list[list[str]], articles: list[list[str]] | None = None,
          part: tuple[int, int, int] | None = None) -> tuple[np.ndarray, ...]:
    """One suffix array over the token streams of some different pages: (page whose
    host it is, hash, pages) of every substring of ``MIN_RUN`` tokens in a host. With
    streams of the pages' articles too, also the number of pages on which it stands
    outside them. ``part``: only those of a round (its number, all rounds, bits of a
    bucket)."""
    n = len(hosts)
    inside = np.repeat([0, 1], n)[:n if articles is None else 2 * n]
    each, size = W.spaced([" ".join(texts) for texts in [*streams, *(articles or [])]])
    page = np.repeat(np.tile(np.arange(n), 2)[:len(inside)], size)
    inside = np.repeat(inside, size)
    place = np.argsort(page, kind="stable")     # a page's streams side by side
    each, page, inside = each[place], page[place], inside[place]
    salt = _salt(hosts)[page]
    window = W.mixed(W.rolling(each, MIN_RUN, _BASE))
    chosen = None
    if part is not None:
        chosen = np.zeros(len(each), bool)
        chosen[:len(window)] = _bucket(window ^ salt[:len(window)], part[2]) % part[1] == part[0]
    which, at, pages = repeats(each ^ salt, page, stream=2 * page + inside, chosen=chosen)      # a token of another host is another token
    found = page[at], window[at].view(np.int64), pages
    if articles is None:
        return found
    out = (which >= 0) & (inside == 0)
    pair = np.unique(which[out] * max(1, n) + page[out])
    return *found, np.bincount(pair // max(1, n), minlength=len(at))


def _windows_of(streams: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(stream, hash) of each ``MIN_RUN`` tokens inside a stream, in their order."""
    each, size = W.spaced(streams)
    of = np.repeat(np.arange(len(streams)), size)
    window = W.mixed(W.rolling(each, MIN_RUN, _BASE)).view(np.int64)
    whole = np.flatnonzero(of[:len(window)] == of[MIN_RUN - 1:]) if len(window) else np.zeros(0, np.int64)
    return of[whole], window[whole]


def _windows(texts: list[str]) -> np.ndarray:
    """Hash of each ``MIN_RUN`` tokens of a page's blocks, read as one stream."""
    return _windows_of([" ".join(texts)])[1]


def _gone(texts: list[str], repeated: np.ndarray) -> np.ndarray:
    """Which tokens of a page's blocks lie in one of the windows."""
    hit = np.isin(_windows(texts), repeated)
    edge = np.zeros(sum(t.count(" ") + 1 for t in texts) + 1, np.int64)
    edge[:len(hit)] += hit
    edge[MIN_RUN:MIN_RUN + len(hit)] -= hit
    return np.cumsum(edge[:-1]) > 0


def _asked(kinds: list[int], texts: list[str]) -> np.ndarray:
    """The different windows of a page's blocks: of those outside the article read
    as one stream, and of each article block by itself."""
    outside = " ".join(t for k, t in zip(kinds, texts, strict=True) if k != ARTICLE)
    return np.unique(_windows_of([outside, *[t for k, t in zip(kinds, texts, strict=True) if k == ARTICLE]])[1])


def _heads(found: list[list[tuple[int, str]]], hosts: list[str]) -> list[list[int]]:
    """For each page the first window of each article block that has one, as a key."""
    begin = [(i, " ".join(t.split(" ", MIN_RUN)[:MIN_RUN])) for i, b in enumerate(found) for k, t in b if k == ARTICLE and t.count(" ") >= MIN_RUN - 1]
    page = np.array([i for i, _ in begin], np.int64)
    keys = _windows_of([t for _, t in begin])[1] ^ _salt(hosts).view(np.int64)[page]
    at = np.searchsorted(page, np.arange(len(found) + 1))
    return [keys[s:e].tolist() for s, e in zip(at[:-1], at[1:], strict=True)]


def _kept(kinds: list[int], texts: list[str], repeated: np.ndarray, template: np.ndarray) -> list[str]:
    """A page's blocks without its host's template; see the module text."""
    judged = [t for k, t in zip(kinds, texts, strict=True) if k != ARTICLE]
    some, sure = _gone(judged, repeated), _gone(judged, template)
    at = size = 0
    cut, whole = {}, {}      # by block: tokens cut at its start and end; tokens of blocks that are covered whole
    for i, (kind, text) in enumerate(zip(kinds, texts, strict=True)):
        n = text.count(" ") + 1
        size += n * (kind != OUT)
        if kind == LOOSE:
            keep = np.flatnonzero(~sure[at:at + n])
            cut[i] = (int(keep[0]), n - 1 - int(keep[-1])) if len(keep) else (n, 0)
            if len(keep) and some[at:at + n].all():
                whole[i] = n
        at += n * (kind != ARTICLE)
    lost = sum(sum(cut[i]) for i in cut if i not in whole) + sum(whole.values())
    if 2 * lost <= size:
        cut |= {i: (n, 0) for i, n in whole.items()}
    copies = {i: t.count(" ") + 1 for i, (k, t) in enumerate(zip(kinds, texts, strict=True))
              if k == ARTICLE and t.count(" ") >= MIN_RUN - 1 and _gone([t], template).all()}
    if 2 * (sum(map(sum, cut.values())) + sum(copies.values())) <= size:
        cut |= {i: (n, 0) for i, n in copies.items()}
    out = []
    for i, (kind, text) in enumerate(zip(kinds, texts, strict=True)):
        if any(cut.get(i, ())):
            words = text.split(" ")
            text = " ".join(words[cut[i][0]:len(words) - cut[i][1]])
        if kind != OUT and text:
            out.append(text)
    return out


def _repeated(parsed: DataFrame, shard_tokens: int) -> tuple[DataFrame, DataFrame]:
    """(window, pages, outside) of all substrings on two different pages of a host or
    more, by key, and (host, size), the hosts' numbers of different pages."""
    spark = parsed.sparkSession
    # of the pages of one text the first goes to the shards; of the others only what they have besides it
    forms = parsed.groupBy("host", "content", "whole").agg(F.min("row").alias("row"))
    texts = forms.groupBy("host", "content").agg(F.min(F.struct("whole", "row"))["row"].alias("row"), F.count(F.lit(1)).alias("n"))
    texts = stage(texts, "html-texts")
    sizes = texts.groupBy("host").agg(F.count(F.lit(1)).alias("size"))
    copies = stage(parsed.select("row").join(texts, "row", "left_anti"), "html-copies")
    many = forms.select("row").join(texts.where("n = 1"), "row", "left_anti")
    many = stage(many.join(texts.select("row", F.lit(True).alias("first")), "row", "left"), "html-forms")

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _PAGES):
                part = batch.slice(start, _PAGES)
                each = []
                for first, kinds, texts, text in zip(*(part[c].to_pylist() for c in ("first", "kinds", "texts", "text")), strict=True):
                    own = np.unique(_windows([t for k, t in zip(kinds, texts, strict=True) if k != ARTICLE]))
                    shown = text.split("\n") if text is not None else [t for k, t in zip(kinds, texts, strict=True) if k != OUT]
                    each.append(own if first else np.setdiff1d(own, _windows(shown)))
                of = np.repeat(np.arange(len(each)), [len(x) for x in each])
                keys = np.concatenate(each) ^ _salt(part["host"].to_pylist()).view(np.int64)[of]
                yield pa.RecordBatch.from_arrays([part["content"].take(pa.array(of)), part["first"].take(pa.array(of)), pa.array(keys)],
                                                 ["content", "first", "window"])

    forms = parsed.select("row", "host", "content", "kinds", "texts", "text").join(many, "row")
    more = forms.mapInArrow(beside, "content long, first boolean, window long")
    more = more.groupBy("content", "window").agg(F.max("first").alias("first")).where("first is null")
    more = stage(more.groupBy("window").agg(F.count(F.lit(1)).alias("n")), "html-beside")

    tokens = parsed.agg(F.sum("tokens")).first()[0] or 0
    bits = min(16, max(8, (tokens // BUCKET_TOKENS).bit_length()))
    rounds = max(1, min(ROUNDS, tokens // ROUND_TOKENS))
    streams = parsed.select("row", "host", "kinds", "texts", "text", "tokens").join(copies, "row", "left_anti").drop("row")
    found = []
    for r in range(rounds):
        part = r, rounds, bits

        def shards(batches: Iterator[pa.RecordBatch], part: tuple[int, int, int] = part) -> Iterator[pa.RecordBatch]:
            held, tokens = [], 0
            for batch in batches:
                for start in range(0, batch.num_rows, _PAGES):
                    rows = batch.slice(start, _PAGES)
                    for host, kinds, texts, text, n in zip(*(rows[c].to_pylist() for c in ("host", "kinds", "texts", "text", "tokens")), strict=True):
                        article = text.split("\n") if text is not None else [t for k, t in zip(kinds, texts, strict=True) if k == ARTICLE]
                        held.append((host, [t for k, t in zip(kinds, texts, strict=True) if k != ARTICLE], article))
                        tokens += n
                        if tokens >= shard_tokens:
                            yield found_in(held, part)
                            held, tokens = [], 0
            if held:
                yield found_in(held, part)

        def found_in(held: list[tuple], part: tuple[int, int, int]) -> pa.RecordBatch:
            hosts, outer, articles = zip(*held, strict=True)
            page, window, pages, outside = shard(hosts, outer, articles, part)
            return packed(window.view(np.uint64) ^ _salt(hosts)[page], pages, outside, bits)

        def besides(batches: Iterator[pa.RecordBatch], part: tuple[int, int, int] = part) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, n = batch["window"].to_numpy().view(np.uint64), batch["n"].to_numpy()
                own = _bucket(keys, part[2]) % part[1] == part[0]
                yield packed(keys[own], n[own], n[own], bits)

        rows = streams.mapInArrow(shards, _PACKED).unionAll(more.mapInArrow(besides, _PACKED))
        found.append(stage(rows.groupBy("bucket").applyInArrow(lambda t: added_up(t, bits), "window long, pages long, outside long"), "html-repeats"))
        del rows
        if rounds > 1:
            release(spark)
    counts = found[0]
    for more_counts in found[1:]:
        counts = counts.unionAll(more_counts)
    return counts, sizes


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """page_id, url and text (blocks joined by a line break) of every page."""
    rows = pages.select(col(id_col).alias("page_id"), col(url_col).alias("url"), col(html_col).alias("html"))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    schema = rows.select("page_id", "url").withColumn("host", host).schema.add("text", "string").add("content", "long").add("whole", "long").add(
        "tokens", "long").add("kinds", T.ArrayType(T.IntegerType())).add("texts", T.ArrayType(T.StringType())).add("heads", T.ArrayType(T.LongType()))

    def hashed(texts: list[str]) -> pa.Array:
        return pa.array(np.array([xxhash.xxh64_intdigest(x) for x in texts], np.uint64).view(np.int64))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(x.as_py()) for x in batch["html"]]
            # a page without loose blocks has its text, unless the host's template stands in it
            done = [None if any(k == LOOSE for k, _ in b) else "\n".join(t for k, t in b if k == ARTICLE) for b in found]
            left = [b if d is None else [x for x in b if x[0] != ARTICLE] for b, d in zip(found, done, strict=True)]
            # pages of one text are one page; without any text, those of one stream
            shown = ["\n".join(t for k, t in b if k != OUT) or "\n".join(t for _, t in b) for b in found]
            heads = _heads([b if d is not None else [] for b, d in zip(found, done, strict=True)], batch["host"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], batch["host"], pa.array(done, pa.string()), hashed(shown),
                 hashed(["\n".join(f"{k} {t}" for k, t in b) for b in found]),
                 pa.array([sum(t.count(" ") + 1 for _, t in b) for b in found], pa.int64()),
                 pa.array([[k for k, _ in b] for b in left], pa.list_(pa.int32())),
                 pa.array([[t for _, t in b] for b in left], pa.list_(pa.string())),
                 pa.array(heads, pa.list_(pa.int64()))],
                ["page_id", "url", "host", "text", "content", "whole", "tokens", "kinds", "texts", "heads"])

    parsed = rows.withColumn("host", host).mapInArrow(parse, schema).withColumn("row", F.monotonically_increasing_id())
    parsed = stage(parsed, "html-blocks")
    counts, sizes = _repeated(parsed, shard_tokens)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _PAGES):
                part = batch.slice(start, _PAGES)
                each = [_asked(kinds, texts) for kinds, texts in zip(part["kinds"].to_pylist(), part["texts"].to_pylist(), strict=True)]
                of = np.repeat(np.arange(len(each)), [len(x) for x in each])
                keys = np.concatenate(each) ^ _salt(part["host"].to_pylist()).view(np.int64)[of]
                yield pa.RecordBatch.from_arrays([part["row"].take(pa.array(of)), pa.array(keys)], ["row", "window"])

    enough = F.col("outside") >= F.greatest(F.lit(TEMPLATE_PAGES), F.lit(TEMPLATE_SHARE) * F.col("size"))
    heads = parsed.select("row", "host", F.explode("heads").alias("window"))
    begun = heads.join(counts.where(F.col("outside") >= TEMPLATE_PAGES).select("window", "outside"), "window")
    alike = stage(begun.join(sizes, "host").where(enough).select("row").distinct(), "html-alike")
    blocks_of = F.split("text", "\n")     # a block has no line break
    again = parsed.join(alike, "row", "left_semi").withColumn("texts", F.concat("texts", blocks_of)).withColumn(
        "kinds", F.concat("kinds", F.transform(blocks_of, lambda _: F.lit(ARTICLE))))
    asked = parsed.where("text is null").unionByName(again)
    own = asked.select("row", "host", "kinds", "texts").mapInArrow(windows, "row long, window long")
    found = own.join(counts, "window").groupBy("row").agg(F.collect_list(F.struct("window", "outside")).alias("repeated"))
    judged = asked.select("row", "host", "page_id", "url", "kinds", "texts").join(found, "row", "left").join(sizes, "host")
    judged = judged.select("page_id", "url", "host", "kinds", "texts", "size", F.col("repeated.window").alias("window"),
                           F.col("repeated.outside").alias("outside"))
    out = parsed.select("page_id", "url", "text").schema

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = []
            for host, kinds, texts, size, window, outside in zip(
                    *(batch[c].to_pylist() for c in ("host", "kinds", "texts", "size", "window", "outside")), strict=True):
                repeated, outside = np.array(window or [], np.int64) ^ _salt([host]).view(np.int64), np.array(outside or [], np.int64)
                least = max(TEMPLATE_PAGES, TEMPLATE_SHARE * size)
                text.append("\n".join(_kept(kinds, texts, repeated, repeated[outside >= least])))
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(text, pa.string())], ["page_id", "url", "text"])

    done = parsed.where("text is not null").join(alike, "row", "left_anti").select("page_id", "url", "text")
    return done.unionAll(judged.mapInArrow(judge, out))


def report(pages: DataFrame) -> DataFrame:
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
