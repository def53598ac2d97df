"""Main text of web pages: structural blocks, and host suffix arrays that find boilerplate.

A page is cut into blocks of text, each marked by where it stands: in navigation, headers, footers, sidebars, notices,
adverts, forms or comments (by element, role or class words), inside ``article`` or ``main``, or loose. Marked blocks
are never main text; the main text is the article's blocks where a page has any, else its loose ones, less those
that the suffix arrays find to be boilerplate:

1. Every block of every page gives up to four keys, its first and its last run of ``MIN_RUN`` tokens and its least in
   two orders (the whole of a shorter block); a page's loose blocks also give the least of any ``LONG`` tokens. A block
   all of whose keys stand on fewer than ``MIN_PAGES`` pages of its host is unique to its page and stays. Marked blocks
   are evidence too: a notice that one page marks tells of its copies.
2. The others' token streams are concatenated, ``GROUP`` pages or ``GROUP_BYTES`` of a host at a time, and their suffix
   array gives all runs of ``MIN_RUN`` and of ``LONG`` tokens with the distinct pages of each; longer runs are chains
   of these. The groups' counts are summed over the host, so groups change no result.
3. A loose block goes where short runs found on ``MIN_PAGES`` pages or more cover half of it; of the others, what long
   runs found on as many pages cover is taken out, and their unique runs stay, joined by a space. An article's block
   goes only as a whole, where short runs found on ``ARTICLE_PAGES`` of the host's distinct articles and on
   ``ARTICLE_SHARE`` of them cover all of it: a few articles that share a heading are no evidence. Pages with an
   article are counted among themselves, and so are those without.

Pages whose texts are copies of one another count once, so that a copied article isn't taken for boilerplate. Copies
are dropped before they meet, so no group grows with them; html is read again instead of being shuffled where the
blocks asked for are few enough to be broadcast (``ASKED_BYTES``, counted).

Defined cases: null html or one without text gives an empty text; a null url is a host of its own; repeated rows
count once as evidence and each get their text; a very long page is one row's work, in time that grows with its
length; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

MIN_RUN = 4
LONG = 12
MIN_PAGES = 3
GROUP = 200
GROUP_BYTES = 8 << 20
ASKED_BYTES = 32 << 20
ARTICLE_PAGES = 8
ARTICLE_SHARE = 0.5
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Element names and class words, in alphabetical order
DROPPED = frozenset("aside button datalist dialog footer form frame head iframe input label menu nav noscript option script select style svg template textarea title".split())
BLOCKS = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
MARKERS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice pagination pager popup promo promotion related replies reply share sharing sidebar sitenav skip social sponsor sponsored subscribe subscription toolbar widget".split())
HEADERS = frozenset("header masthead".split())
CONTENT = frozenset("article main".split())
IMPLIED_END = {"p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}

_OPEN = re.compile(r"<(?:(!--)|(!\[CDATA\[)|[!?]|(/?)([A-Za-z][A-Za-z0-9:-]*))")
_TO_END = re.compile(r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>")  # a quote counts after an equals sign
_ATTR = re.compile(r"(?:\A|\s)(class|id|role|hidden|aria-hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe")}
_TOO_LARGE = re.compile(r"&#(?:[xX]0*[1-9a-fA-F][0-9a-fA-F]{6,}|0*[1-9][0-9]{7,});?")
_ZEROS = re.compile(r"(?<=&#)0+(?=[0-9])")
_HOLDS = re.compile(r"<(?:article|main)[\s>]", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _marked(attrs: str, inside: bool) -> bool:
    """Whether the attributes say that the element isn't part of the article; an article's own header is."""
    for m in _ATTR.finditer(attrs):
        name, value = m.group(1).lower(), next((g for g in m.groups()[1:] if g is not None), "")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name in ("class", "id") and (MARKERS - HEADERS if inside else MARKERS).intersection(_SPLIT.split(_CAMEL.sub(" ", value).lower())):
            return True
    return False


MARKED, INSIDE, LOOSE = 0, 1, 2


def _plain(raw: str) -> str:
    """Character references decoded (numbers beyond Unicode: the replacement character), white space as one space."""
    if "&#" in raw:
        raw = _TOO_LARGE.sub("\ufffd", _ZEROS.sub("", raw))
    return " ".join(entities.unescape(raw).split())


def parts(page: str, wrappers: bool = True) -> list[tuple[str, int]]:
    """(text, ``MARKED``, ``INSIDE`` or ``LOOSE``) of every block, in page order.

    Without ``wrappers``, class words outside articles are not looked at (a layout's class may name its sidebar).
    """
    out: list[tuple[str, int]] = []
    buffer: list[str] = []
    held: list[list[str]] = []  # the text around an inline element that is marked
    stack: list[tuple[str, bool, bool, bool]] = []  # element, opens a marked part, opens content, holds the text around it
    open_names: dict[str, int] = {}
    block_at: list[int] = []
    marked = content = 0

    def flush():
        text = _plain("".join(buffer))
        if text:
            out.append((text, MARKED if marked else INSIDE if content else LOOSE))
        buffer.clear()

    def pop():
        nonlocal marked, content, buffer
        name, bad, main, holds = stack.pop()
        open_names[name] -= 1
        if block_at and block_at[-1] == len(stack):
            block_at.pop()
        if name in BLOCKS or bad or main:
            flush()
        marked -= bad
        content -= main
        if holds:
            buffer = held.pop()

    at, n, last = 0, len(page), page.rfind(">")
    while at < n:
        start = page.find("<", at)
        if start < 0 or start > last:
            buffer.append(page[at:])
            break
        m = _OPEN.match(page, start)
        if m is None:
            buffer.append(page[at : start + 1])
            at = start + 1
            continue
        buffer.append(page[at:start])
        name = m.group(4)
        if name is None:
            close = "-->" if m.group(1) else "]]>" if m.group(2) else ">"
            end = page.find(close, m.end())
            if m.group(2):
                buffer.append(entities.escape(page[m.end() : end if end >= 0 else n]))
            at = end + len(close) if end >= 0 else n
            continue
        end = _TO_END.match(page, m.end())
        attrs = end.group(1) if end else ""
        at = end.end() if end else page.find(">", start) + 1
        name = name.lower()
        if m.group(3):
            if open_names.get(name):
                while stack[-1][0] != name:
                    pop()
                pop()
            elif name in BLOCKS:
                flush()
            continue
        if name in _RAW_END:
            end = _RAW_END[name].search(page, at)
            at = page.find(">", end.end()) + 1 or n if end else n
            continue
        if name == "br":
            buffer.append(" ")
            continue
        while stack and stack[-1][0] in IMPLIED_END and name in IMPLIED_END[stack[-1][0]]:
            pop()
        if name in BLOCKS and block_at and stack[block_at[-1]][0] == "p":
            # an open paragraph ends here, with the inline elements that were left open in it
            k = block_at[-1]
            while len(stack) > k:
                pop()
        inside = content > 0
        bad = name in DROPPED or (name == "header" and not inside) or (name not in ("body", "html") and name not in CONTENT and (inside or wrappers) and bool(attrs) and _marked(attrs, inside))
        main = name in CONTENT or (bool(attrs) and "articlebody" in attrs.lower())
        void = name in VOID or attrs.endswith("/")
        holds = bad and not marked and not void and name not in BLOCKS
        if holds:
            held.append(buffer)
            buffer = []
        elif name in BLOCKS or main or (bad and not void):
            flush()
        if void:
            continue
        # an article inside a marked part (a list of related ones, a comment) stays marked
        if name in BLOCKS:
            block_at.append(len(stack))
        stack.append((name, bad, main and not marked and not bad, holds))
        open_names[name] = open_names.get(name, 0) + 1
        marked += bad
        content += stack[-1][2]
    while stack:
        pop()
    flush()
    return out


def page_parts(page: str | None) -> list[tuple[str, int]]:
    """The blocks of a page; class words that would mark all of its article are not believed."""
    found = parts(page or "")
    if not any(state == INSIDE for _, state in found) and _HOLDS.search(page or ""):
        found = parts(page, wrappers=False)
    return found


def blocks(page: str, wrappers: bool = True) -> list[tuple[str, bool]]:
    """(text, whether it stands inside an article) of the blocks that aren't marked."""
    return [(t, state == INSIDE) for t, state in parts(page, wrappers) if state != MARKED]


def main_blocks(found: list[tuple[str, int]]) -> list[int]:
    """The blocks that may be main text: the article's, else the loose ones."""
    inside = [i for i, (_, state) in enumerate(found) if state == INSIDE]
    return inside or [i for i, (_, state) in enumerate(found) if state == LOOSE]


# ---------------------------------------------------------------- suffix array of a host's pages


def suffix_array(tokens: np.ndarray, deep: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, lengths of the prefixes shared with the suffix before), by prefix doubling; both exact up to ``deep`` tokens. Tokens are >= 0; unique ones serve as block ends."""
    n = len(tokens)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    deep = deep or n
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < min(deep, n):
        nxt = np.full(n, -1, np.int64)
        nxt[:-step] = rank[step:]
        key = rank * (n + 1) + nxt + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = new
        step *= 2
        if rank[order[-1]] == n - 1:
            break
    sa = np.argsort(rank, kind="stable")
    lcp = np.zeros(n, np.int64)
    live = np.arange(1, n)
    depth = 0
    while len(live) and depth < deep:  # all neighbours at once, a token a round
        a, b = sa[live] + depth, sa[live - 1] + depth
        ok = np.maximum(a, b) < n
        ok[ok] = tokens[a[ok]] == tokens[b[ok]]
        live = live[ok]
        depth += 1
        lcp[live] = depth
    return sa, lcp


def _pages_of_runs(sa: np.ndarray, lcp: np.ndarray, page: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """(groups of neighbouring suffixes that share ``run`` tokens, distinct pages of each group); page -1: a separator."""
    group = np.cumsum(lcp < run) - 1
    pairs = np.unique(group * (int(page.max()) + 2) + page[sa] + 1)
    return group, np.bincount(pairs // (int(page.max()) + 2), minlength=int(group[-1]) + 1)


def repeated(tokens: np.ndarray, page: np.ndarray, min_run: int = MIN_RUN, min_pages: int = MIN_PAGES) -> np.ndarray:
    """Marks of tokens that lie in a run of ``min_run`` tokens found on ``min_pages`` distinct pages (page -1: a separator)."""
    if len(tokens) == 0:
        return np.zeros(0, bool)
    sa, lcp = suffix_array(tokens, min_run)
    group, pages = _pages_of_runs(sa, lcp, page, min_run)
    return _covered(len(tokens), sa[(pages[group] >= min_pages) & (page[sa] >= 0)], min_run)


def _covered(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    covered = np.zeros(n, bool)
    for k in range(size):
        at = starts + k
        covered[at[at < n]] = True
    return covered


class _Group:
    """The token streams of blocks of some distinct pages of a host, and the hashes of their runs and short blocks."""

    def __init__(self, content: np.ndarray, texts: list[str]):
        self.page = np.unique(content, return_inverse=True)[1]  # of each block
        data, offsets = C.text_bytes(pa.array(texts, pa.string()))
        s, e, first = C.words(data, offsets)
        different, word = C.distinct_ranges(data, s, e)
        hashes = C.range_hashes(data, s[different], e[different])[word] if len(s) else np.zeros(0, np.uint64)
        n = len(texts)
        size = np.diff(first)
        # blocks one after another, each with an end that is found nowhere else
        self.starts = first[:-1] + np.arange(n)
        self.ends = self.starts + size
        real = np.ones(len(s) + n, bool)
        real[self.ends] = False
        self.tokens = np.empty(len(real), np.int64)
        self.tokens[real] = word
        self.tokens[~real] = len(different) + np.arange(n)
        self.owner = np.repeat(np.arange(n), size + 1)
        self.of_token = np.where(real, self.page[self.owner], -1)
        values = np.zeros(len(real), np.uint64)
        values[real] = hashes
        self.runs, self.run_hash = self._runs(values, MIN_RUN)
        self.longs, self.long_hash = self._runs(values, LONG)
        self.short = np.flatnonzero(size < MIN_RUN)
        self.short_hash = C.range_hashes(data, offsets[self.short], offsets[self.short + 1]).view(np.int64)

    def _runs(self, values: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes) of the runs that lie in a block."""
        at = np.arange(len(values))
        at = at[at + run <= self.ends[self.owner]]
        return at, C.window_hashes(values, run)[at].view(np.int64) if len(at) else np.zeros(0, np.int64)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of the runs and short blocks, distinct pages of each)."""
        if len(self.tokens) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sa, lcp = suffix_array(self.tokens, LONG)
        pairs = np.unique(np.stack([self.short_hash, self.page[self.short]]), axis=1)
        found = [np.unique(pairs[0], return_counts=True)]
        for run, starts, hashes in ((MIN_RUN, self.runs, self.run_hash), (LONG, self.longs, self.long_hash)):
            group, pages = _pages_of_runs(sa, lcp, self.of_token, run)
            of = np.empty(len(sa), np.int64)
            of[sa] = group
            _, one = np.unique(of[starts], return_index=True)
            found.append((hashes[one], pages[of[starts[one]]]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _cover(self, common: np.ndarray) -> np.ndarray:
        """Tokens of every block that common runs cover, all of a short block that is common."""
        mark = _covered(len(self.tokens), self.runs[np.isin(self.run_hash, common)], MIN_RUN)
        hit = np.concatenate([[0], np.cumsum(mark)])
        out = hit[self.ends] - hit[self.starts]
        out[self.short] = np.where(np.isin(self.short_hash, common), (self.ends - self.starts)[self.short], 0)  # they can't hold a run
        return out

    def goes(self, state: np.ndarray, found: np.ndarray, n: np.ndarray, pages: int) -> dict[int, list[tuple[int, int]]]:
        """Of each block that is boilerplate or holds some, the tokens (from, to) that go, by the host's counts ``n`` of runs ``found`` and its distinct pages."""
        size = self.ends - self.starts
        often, most = found[n >= MIN_PAGES], found[n >= max(ARTICLE_PAGES, ARTICLE_SHARE * pages)]
        whole = np.where(state == INSIDE, self._cover(most) == size, (state == LOOSE) & (2 * self._cover(often) >= size))
        out = {i: [(0, int(size[i]))] for i in np.flatnonzero(whole).tolist()}
        mark = _covered(len(self.tokens), self.longs[np.isin(self.long_hash, often)], LONG)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
        for a, b in edge.reshape(-1, 2).tolist():  # a run doesn't pass its block's end
            i = int(self.owner[a])
            if state[i] == LOOSE and not whole[i]:
                out.setdefault(i, []).append((a - int(self.starts[i]), b - int(self.starts[i])))
        return out


def _group_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    found, n = _Group(pdf["content"].to_numpy(), pdf["text"].tolist()).counts()
    return pd.DataFrame({"host": pdf["host"].iloc[0], "part": pdf["part"].iloc[0], "found": found, "n": n})


_GONE = "host long, content long, block int, lo array<int>, hi array<int>"


def _group_verdicts(pdf: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """The token ranges that go, of each block that loses any."""
    names = [x.split()[0] for x in _GONE.split(", ")]
    if len(pdf) == 0:
        return pd.DataFrame(columns=names, dtype=object)
    gone = _Group(pdf["content"].to_numpy(), pdf["text"].tolist()).goes(pdf["state"].to_numpy(), counts["found"].to_numpy(np.int64), counts["n"].to_numpy(np.int64), int(pdf["pages"].iloc[0]))
    own = pdf.iloc[list(gone)]
    side = lambda k: pd.Series([[s[k] for s in spans] for spans in gone.values()], index=own.index, dtype=object)
    return own[["host", "content", "block"]].assign(lo=side(0), hi=side(1))


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """A block's words outside some ranges, joined by a space."""
    words = _WORD.findall(text)
    for a, b in sorted(spans, reverse=True):
        del words[a:b]
    return " ".join(words)


# ---------------------------------------------------------------- the passes over the pages


def block_keys(texts: list[str], loose: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, the block of each): a block's first and last run and its least ones in two orders, or the whole of a shorter block; of ``loose`` ones also the least of every ``LONG`` tokens."""
    data, offsets = C.text_bytes(pa.array(texts, pa.string()))
    h, first = C.word_hashes(data, offsets)
    whole = C.range_hashes(data, offsets[:-1], offsets[1:])
    keys = np.repeat(whole[:, None], 4, 1)
    long = np.flatnonzero(np.diff(first) >= MIN_RUN)
    if len(long):
        runs = C.window_hashes(h, MIN_RUN)
        a, b = first[long], first[long + 1] - MIN_RUN
        inside = np.zeros(len(runs) + 1, np.int64)
        np.add.at(inside, a, 1)
        np.add.at(inside, b + 1, -1)
        beyond = np.cumsum(inside)[: len(runs)] == 0
        keys[long, 0], keys[long, 1] = runs[a], runs[b]
        for column, order in ((2, runs), (3, C.mix(runs))):
            keys[long, column] = np.minimum.reduceat(np.where(beyond, np.iinfo(np.uint64).max, order), a)
    keys.sort(axis=1)
    new = np.ones(keys.shape, bool)
    new[:, 1:] = keys[:, 1:] != keys[:, :-1]
    block, at = np.nonzero(new)
    found = [(keys[block, at], block)]
    for i in np.flatnonzero(loose & (np.diff(first) >= LONG)).tolist():
        inside = runs[first[i] : first[i + 1] - MIN_RUN + 1]
        least = np.unique(np.lib.stride_tricks.sliding_window_view(inside, LONG - MIN_RUN + 1).min(1))
        found.append((least, np.full(len(least), i)))
    return tuple(np.concatenate(x) for x in zip(*found))


def scope_of(site: int, found: list[tuple[str, int]]) -> int:
    """Pages with an article and pages without one are judged among themselves."""
    return site ^ any(state == INSIDE for _, state in found)


def content_of(found: list[tuple[str, int]]) -> int:
    """What makes two pages copies of one another: their main blocks."""
    text = "\n".join(found[i][0] for i in main_blocks(found))
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _evidence(batches):
    """A row for every key of every block, of one copy of each page that a task reads; of the others one row, without a key."""
    seen: set[tuple[int, int]] = set()

    def rows(pages):
        texts = [t for *_, found in pages for t, _ in found]
        state = np.array([x for *_, found in pages for _, x in found], np.int64)
        size = np.array([len(found) for *_, found in pages], np.int64)
        loose = (state == LOOSE) & np.repeat([not any(x == INSIDE for _, x in found) for *_, found in pages], size)
        keys, block = block_keys(texts, loose) if texts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        page = np.repeat(np.arange(len(pages)), size)[block]
        spot = (np.arange(len(texts)) - np.repeat(np.cumsum(size) - size, size))[block]
        ids = np.array([x[:4] for x in pages], np.int64).reshape(-1, 4)[page]
        return pa.RecordBatch.from_arrays([*(pa.array(ids[:, k]) for k in range(4)), pa.array(spot.astype(np.int32)), pa.array(state[block].astype(np.int32)), pa.array(keys.view(np.int64))], _EVIDENCE)

    for b in batches:
        held, size, copies = [], 0, []
        for site, page, html in zip(*(b.column(k).to_pylist() for k in ("site", "page", "html"))):
            found = page_parts(html)
            if not found:
                continue
            content, host = content_of(found), scope_of(site, found)
            if (host, content) in seen:
                copies.append((site, page, host, content))
                continue
            if len(seen) >= 500_000:  # copies beyond are dropped where pages meet
                seen.clear()
            seen.add((host, content))
            held.append((site, page, host, content, found))
            size += len(html)
            if size > C.SLICE_BYTES:
                yield rows(held)
                held, size = [], 0
        if held:
            yield rows(held)
        if copies:
            n = len(copies)
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in zip(*copies)), pa.array([-1] * n, pa.int32()), pa.array([MARKED] * n, pa.int32()), pa.nulls(n, pa.int64())], _EVIDENCE)


_EVIDENCE = ["site", "page", "host", "content", "block", "state", "key"]


def _asked_blocks(batches):
    for b in batches:
        rows: list[list] = [[], [], [], [], []]
        for host, content, asked, html in zip(*(b.column(k).to_pylist() for k in ("host", "content", "asked", "html"))):
            found = page_parts(html)
            spot = {i: k for k, i in enumerate(main_blocks(found))}
            for i in asked:
                # a block of the main text is told by its place there, which copies share; others are evidence alone
                state = found[i][1] if i in spot else MARKED
                for column, value in zip(rows, (host, content, spot.get(i, -1 - i), state, found[i][0])):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()))], ["host", "content", "block", "state", "text"])


def _texts(batches):
    for b in batches:
        out = []
        for html, gone in zip(b.column("html").to_pylist(), b.column("gone").to_pylist()):
            found = page_parts(html)
            spans = {x["block"]: list(zip(x["lo"], x["hi"])) for x in gone or ()}
            kept = (without(found[i][0], spans[k]) if k in spans else found[i][0] for k, i in enumerate(main_blocks(found)))
            out.append("\n".join(filter(None, kept)))
        yield pa.RecordBatch.from_arrays([b.column("page_id").cast(pa.int64()), b.column("url").cast(pa.string()), pa.array(out, pa.string())], ["page_id", "url", "text"])


def _with(pages: DataFrame, side: DataFrame, per_page: str, item: int, how: str) -> DataFrame:
    """Pages joined to a table of a row for each page's hash and an array of items of so many bytes: broadcast where that is of few bytes."""
    rows, items = side.agg(F.count("*"), F.sum(F.size(per_page))).first()
    small = 64 * rows + item * (items or 0) <= ASKED_BYTES
    return pages.join(F.broadcast(side) if small else side, ["site", "page"], how)


def boilerplate(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """(site, page, gone): the main blocks that lose tokens, by place, and which, of pages (site, page, html) that lose any."""
    marks = C.staged(pages.mapInArrow(C.released(_evidence), "site long, page long, host long, content long, block int, state int, key long"))
    often = marks.where("key is not null").groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_PAGES).select("host", "key")
    asked = marks.join(often, ["host", "key"], "left_semi").groupBy("site", "page", "host", "content").agg(F.array_sort(F.collect_set("block")).alias("asked"))  # at most a page's blocks
    asked = C.staged(asked)
    fetched = _with(pages, asked, "asked", 8, "inner").mapInArrow(C.released(_asked_blocks), "host long, content long, block int, state int, text string")
    sizes = marks.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    sizes = C.staged(sizes)
    fetched = C.staged(C.small_or_salted_join(fetched.dropDuplicates(["host", "content", "block"]), sizes, "host", sizes.count()))
    weight = C.staged(fetched.groupBy("host").agg(F.sum(F.octet_length("text")).alias("bytes")))
    placed = C.small_or_salted_join(fetched, weight, "host", weight.count())
    parts = F.ceil(F.greatest(F.col("pages") / F.lit(group), F.col("bytes") / F.lit(GROUP_BYTES)))
    placed = placed.withColumn("part", F.pmod("content", parts).cast("long")).drop("bytes")
    counts = C.staged(placed.groupBy("host", "part").applyInPandas(_group_counts, "host long, part long, found long, n long"))
    whole = counts.groupBy("host", "found").agg(F.sum("n").alias("total")).where(F.col("total") >= MIN_PAGES)
    common = counts.join(whole, ["host", "found"]).select("host", "part", "found", F.col("total").alias("n"))
    gone = placed.where(F.col("state") > MARKED).groupBy("host", "part").cogroup(common.groupBy("host", "part")).applyInPandas(_group_verdicts, _GONE)
    gone = gone.groupBy("host", "content").agg(F.collect_list(F.struct("block", "lo", "hi")).alias("gone"))  # at most a page's blocks
    out = C.staged(marks.select("site", "page", "host", "content").distinct().join(gone, ["host", "content"]).select("site", "page", "gone"))
    for x in (marks, asked, sizes, fetched, weight, counts):
        C.drop_stage(x)
    return out


def with_page(pages: DataFrame) -> DataFrame:
    """Pages with their host's hash (of a null url: null's) and a hash of their html."""
    host = F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)", 1))
    return pages.select("page_id", "url", "html", F.xxhash64(host).alias("site"), F.xxhash64(F.lit(3), "html").alias("page"))


def extract(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    pages = with_page(pages.select("page_id", "url", "html"))
    gone = boilerplate(pages.select("site", "page", "html"), group)
    out = _with(pages, gone, "gone", 96, "left").select("page_id", "url", "html", "gone").mapInArrow(C.released(_texts), "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
