"""Joins by string likeness inside blocks, exact but without scoring all pairs.

Equal names count once. Left names are dealt to chunks and right ones to parts of a bounded size, and every chunk
meets every part of its block. There, the right names form a trie, and the bit-parallel rows of the longest common
subsequence go down it for many left names at once: a start that names share costs once, and where all pairs above a
cutoff are asked for, branches that can't reach it are left. A best match takes the likeness of sorted words from there
and upper bounds for the rest, and scores in full, in order of the bounds, until no name left can win.

Left names of over 64 characters go by upper bounds from counts alone: of characters and of pairs of neighbouring
characters, in buckets (a collision only raises a bound), of words in common and of lengths. With l the longest common subsequence of texts of m and n characters: l is at most the number of common characters;
and since a removed character breaks two pairs of neighbours and an added one breaks one, at least
(m - 1) - 2 (m - l) - (n - l) pairs are common, so 3 l is at most those plus 1 + m + n.
"""

from __future__ import annotations

from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity, text
from ..sources.stages import merged

CHUNK, PART = 2_000, 20_000
CHARS, PAIRS, WORDS = 64, 128, 32
FEW, MANY = 4, 64  # right names, pairs: from there on bounds, or a trie, are worth their cost
BITS = 64
CELLS = 400_000
_SLACK = 1e-9


def _step(row: np.ndarray, mask: np.ndarray, full: np.ndarray) -> np.ndarray:
    u = row & mask
    return ((row + u) | (row - u)) & full


def _full(size: np.ndarray) -> np.ndarray:
    """As many low bits as a text has characters, ``BITS`` at most."""
    return np.where(size >= BITS, np.uint64(2**BITS - 1), (np.uint64(1) << (size % BITS).astype(np.uint64)) - np.uint64(1))


def _runs(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which run, place) of all places of the runs."""
    which = np.repeat(np.arange(len(count)), count)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + start[which]


class Trie:
    """Texts by shared starts, level by level: each node's parent and character, its children, the texts that end there, and the lengths of the texts below."""

    def __init__(self, texts: list[str]):
        self.order = np.array(sorted(range(len(texts)), key=texts.__getitem__), np.int64)
        flat, own = _codes([texts[i] for i in self.order])
        self.size = np.array([len(texts[i]) for i in self.order], np.int64)
        self.letters, code = np.unique(flat, return_inverse=True)
        letter = np.zeros((len(texts), int(self.size.max(initial=0))), np.int32)
        letter[own, np.arange(len(own)) - np.repeat(np.cumsum(self.size) - self.size, self.size)] = code + 1
        fresh = np.ones(letter.shape, bool)
        fresh[1:] = np.logical_or.accumulate(letter[1:] != letter[:-1], axis=1)
        self.levels, above = [], np.zeros(len(texts), np.int64)
        for p in range(letter.shape[1]):
            rows = np.flatnonzero(self.size > p)
            opens = np.flatnonzero(fresh[rows, p])
            first = rows[opens]
            node = np.cumsum(fresh[rows, p]) - 1
            ends = self.size[rows] == p + 1
            n_ends = np.bincount(node[ends], minlength=len(first))
            parent = above[first]
            if self.levels:
                kids = np.bincount(parent, minlength=len(self.levels[-1]["parent"]))
                self.levels[-1] |= {"kids": kids, "kid": np.cumsum(kids) - kids}
            self.levels.append({
                "parent": parent, "letter": letter[first, p], "end_rows": rows[ends], "end_nodes": node[ends], "ends": n_ends, "end": np.cumsum(n_ends) - n_ends,
                "least": np.minimum.reduceat(self.size[rows], opens), "most": np.maximum.reduceat(self.size[rows], opens),
            })
            above[rows] = node
        if self.levels:
            none = np.zeros(len(self.levels[-1]["parent"]), np.int64)
            self.levels[-1] |= {"kids": none, "kid": none}

    def masks(self, texts: list[str]) -> np.ndarray:
        """Where each letter stands in each text [texts, letters]; the first letter is none."""
        out = np.zeros((len(texts), len(self.letters) + 1), np.uint64)
        flat, own = _codes(texts)
        if len(flat) and len(self.letters):
            size = np.array([len(t) for t in texts], np.int64)
            at = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
            place = np.minimum(np.searchsorted(self.letters, flat), len(self.letters) - 1)
            known = self.letters[place] == flat
            np.bitwise_or.at(out, (own[known], place[known] + 1), np.uint64(1) << at[known].astype(np.uint64))
        return out

    def common(self, texts: list[str]) -> np.ndarray:
        """The longest common subsequence of each text (of ``BITS`` characters at most) with each of the trie's [texts, texts of the trie]."""
        masks, full = self.masks(texts), _full(np.array([len(t) for t in texts], np.int64))[:, None]
        out, row = np.zeros((len(texts), len(self.order)), np.int64), full
        for k, level in enumerate(self.levels):
            row = _step(row[:, level["parent"]] if k else row, masks[:, level["letter"]], full)
            out[:, self.order[level["end_rows"]]] = np.bitwise_count(~row[:, level["end_nodes"]] & full)
        return out

    def near(self, texts: list[str], cutoff: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, text of the trie, common subsequence) of all pairs whose likeness reaches the cutoff (over 0, up to 100).

        With n characters of which ``need`` must be common, at most n - need are not, and none of the common ones lies
        further on than that many of the text's own: a branch ends where more of its characters are out.
        """
        m = np.array([len(t) for t in texts], np.int64)
        masks, full, share = self.masks(texts), _full(m), cutoff / 200
        need = lambda i, n: np.ceil(share * (m[i] + n) - _SLACK).astype(np.int64)
        low, high = np.ceil(m * share / (1 - share) - 1e-6).astype(np.int64), np.floor(m * (1 - share) / share + 1e-6).astype(np.int64)
        empty = np.flatnonzero(self.size == 0)
        found = [(np.repeat(np.flatnonzero(m == 0), len(empty)), np.tile(empty, int((m == 0).sum())), np.zeros(len(empty) * int((m == 0).sum()), np.int64))]
        own = np.flatnonzero(m > 0)
        for k, level in enumerate(self.levels):
            if not k:
                i, node = np.repeat(own, len(level["parent"])), np.tile(np.arange(len(level["parent"])), len(own))
                row = full[i]
            else:
                which, node = _runs(above["kid"][node], above["kids"][node])
                i, row = i[which], row[which]
            most, least = np.minimum(level["most"][node], high[i]), np.maximum(level["least"][node], low[i])
            fits = most >= least
            i, node, row, most, least = i[fits], node[fits], row[fits], most[fits], least[fits]
            row = _step(row, masks[i, level["letter"][node]], full[i])
            within = _full(np.minimum(k + 1 + m[i] - need(i, least), m[i]))
            alive = k + 1 - np.bitwise_count(~row & within).astype(np.int64) <= most - need(i, most)
            i, node, row, above = i[alive], node[alive], row[alive], level
            if not len(i):
                break
            which, at = _runs(level["end"][node], level["ends"][node])
            if len(which):
                at, common = level["end_rows"][at], np.bitwise_count(~row[which] & full[i[which]]).astype(np.int64)
                good = 200.0 * common / (m[i[which]] + self.size[at]) >= cutoff
                found.append((i[which][good], at[good], common[good]))
        i, at, common = (np.concatenate(x) for x in zip(*found))
        return i, self.order[at], common


def partials(x: str, others: list[str]) -> np.ndarray:
    """``similarity.partial`` of a text of ``BITS`` characters at most with many others."""
    out, m, trie = np.full(len(others), -1.0), len(x), None
    sizes = np.array([len(y) for y in others], np.int64)
    out[sizes == 0] = 0.0 if m else 100.0
    if not m:
        out[sizes > 0] = 0.0
        return out
    letters = sorted(set(x))
    code = {c: k + 1 for k, c in enumerate(letters)}
    mask = np.zeros(len(letters) + 1, np.uint64)
    for k, c in enumerate(x):
        mask[code[c]] |= np.uint64(1 << k)
    for n in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == n)
        best = np.full(len(at), -1.0)
        text_codes = np.array([[code.get(c, 0) for c in others[j]] for j in at], np.int64)
        if m <= n:  # stretches of the other text
            starts = np.arange(1 - m, n)
            begin, end = np.maximum(starts, 0), np.minimum(starts + m, n)
            padded, full = np.concatenate([text_codes, np.zeros((len(at), m), np.int64)], 1), _full(np.array([m]))[0]
            row = np.full((len(at), len(starts)), full)
            for t in range(m):
                row = _step(row, np.where(begin + t < end, mask[padded[:, begin + t]], np.uint64(0)), full)
            best = np.maximum(best, (200.0 * np.bitwise_count(~row & full) / (m + end - begin)).max(1))
        if m >= n:  # stretches of this one
            starts = np.arange(1 - n, m)
            begin, end = np.maximum(starts, 0), np.minimum(starts + n, m)
            full, shift = _full(end - begin), begin.astype(np.uint64)
            row = np.broadcast_to(full, (len(at), len(starts)))
            for t in range(n):
                row = _step(row, mask[text_codes[:, t]][:, None] >> shift, full)
            best = np.maximum(best, (200.0 * np.bitwise_count(~row & full) / (n + end - begin)).max(1))
        out[at] = best
    return out


class Names:
    """Texts and what bounds their likeness: sorted words, counts of characters and pairs of them, words by bucket."""

    def __init__(self, texts: list[str]):
        self.text = texts
        split = [t.split() for t in texts]
        self.sorted = [" ".join(sorted(w)) for w in split]
        self.set = [" ".join(sorted(set(w))) for w in split]
        self.size = np.array([len(t) for t in texts], np.int32)
        self.sorted_size = np.array([len(t) for t in self.sorted], np.int32)
        self.set_size = np.array([len(t) for t in self.set], np.int32)

    # worked out when asked for: small blocks are scored at once
    @cached_property
    def plain(self) -> bool:
        """Whether all texts are their sorted words already, each once."""
        return self.text == self.sorted == self.set

    @cached_property
    def repeats(self) -> np.ndarray:
        """Texts that hold a word twice."""
        return self.sorted_size != self.set_size

    @cached_property
    def sorted_trie(self) -> Trie:
        return Trie(self.sorted)

    @cached_property
    def text_trie(self) -> Trie:
        return self.sorted_trie if self.plain else Trie(self.text)

    @cached_property
    def holders(self) -> dict[str, np.ndarray]:
        """Which texts hold each word."""
        out: dict[str, list[int]] = {}
        for i, w in enumerate(self.set):
            for x in w.split():
                out.setdefault(x, []).append(i)
        return {w: np.array(i) for w, i in out.items()}

    @cached_property
    def chars(self) -> np.ndarray:
        flat, own = _codes(self.text)
        return _counted(flat % CHARS, own, CHARS, len(self.text))

    @cached_property
    def pairs(self) -> np.ndarray:
        return _counted(*_neighbours(*_codes(self.sorted)), PAIRS, len(self.text))

    @cached_property
    def words(self) -> np.ndarray:
        out = np.zeros((len(self.text), WORDS), np.uint16)
        for i, w in enumerate(self.set):
            for x in w.split():
                out[i, sum(map(ord, x)) % WORDS] += len(x) + 1
        return out

    def common(self, which: str, i: int, other: Names, at) -> np.ndarray:
        return np.minimum(getattr(other, which)[at], getattr(self, which)[i]).sum(1, dtype=np.int32)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, the text of each)."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.repeat(np.arange(len(texts)), [len(t) for t in texts])


def _neighbours(flat: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each pair of neighbouring characters, its text)."""
    same = own[1:] == own[:-1]
    return ((flat[:-1].astype(np.uint64) * np.uint64(31) + flat[1:]) % np.uint64(PAIRS))[same], own[:-1][same]


def _counted(bucket: np.ndarray, own: np.ndarray, width: int, n: int) -> np.ndarray:
    """Counts [texts, buckets]."""
    return np.bincount(own * width + bucket.astype(np.int64), minlength=n * width).astype(np.uint16).reshape(n, width)


def _ratio(common, total) -> np.ndarray:
    return np.where(total > 0, 200.0 * common / np.maximum(total, 1), 100.0)


class SortMeasure:
    """Likeness of the sorted words."""

    def bound(self, a: Names, i: int, b: Names, at) -> np.ndarray:
        total = a.sorted_size[i] + b.sorted_size[at]
        return _ratio(np.minimum(a.common("chars", i, b, at), (a.common("pairs", i, b, at) + 1 + total) / 3), total)

    rough = bound

    def score(self, a: Names, i: int, b: Names, j: int, least: float) -> float:
        return similarity.indel(a.sorted[i], b.sorted[j])


class NameMeasure(SortMeasure):
    """The mixed score of names: sorted words, sets of words, best stretch."""

    def rough(self, a: Names, i: int, b: Names, at) -> np.ndarray:
        """From characters alone."""
        common, total = a.common("chars", i, b, at), a.size[i] + b.size[at]
        sort = _ratio(np.minimum(common, np.minimum(a.sorted_size[i], b.sorted_size[at])), a.sorted_size[i] + b.sorted_size[at])
        return 0.55 * np.minimum(sort, 100) + 0.25 * 100 + 0.20 * self._partial(common, a.size[i], b.size[at], total)

    @staticmethod
    def _partial(common, m, n, total):
        short = np.minimum(m, n)
        return np.where(total > 0, np.minimum(100.0, 200.0 * common / np.maximum(short + common, 1)), 100.0)

    def bound(self, a: Names, i: int, b: Names, at) -> np.ndarray:
        common = a.common("chars", i, b, at)
        sort = np.minimum(super().bound(a, i, b, at), 100)
        m, n = a.set_size[i], b.set_size[at]
        least = np.minimum(m, n)
        held = np.minimum(a.common("words", i, b, at), least)  # characters of common words at most
        sets = np.maximum(np.where(least > 0, 200.0 * held / np.maximum(held + least, 1), 0.0), np.minimum(_ratio(np.minimum(common, least), m + n), 100))
        return 0.55 * sort + 0.25 * sets + 0.20 * self._partial(common, a.size[i], b.size[at], a.size[i] + b.size[at])

    def score(self, a: Names, i: int, b: Names, j: int, least: float) -> float:
        x, y = a.text[i], b.text[j]
        sort, sets = similarity.indel(a.sorted[i], b.sorted[j]), similarity.token_set(x, y)
        cut = 0.75 if min(len(x), len(y)) < 0.55 * max(len(x), len(y)) and sets > sort + 15 else 1.0
        if (0.55 * sort + 0.25 * sets + 20.0) * cut < least:
            return -1.0
        return max((0.55 * sort + 0.25 * sets + 0.20 * similarity.partial(x, y)) * cut, 0.0)


MEASURES = {"sort": SortMeasure(), "name": NameMeasure()}


def _allowed(kind: str, years: str, kinds: np.ndarray, year_no: np.ndarray, year_sets: list[str]) -> np.ndarray:
    """Which right names don't conflict in structure."""
    own = set(filter(None, years.split(",")))
    fits = np.array([not own or not y or bool(own & set(y.split(","))) for y in year_sets], bool)
    return (kinds == kind) & fits[year_no]


def _best(longest: bool, measure, a: Names, i: int, b: Names, at: np.ndarray, less: np.ndarray, cutoff: float, ids: list) -> list[tuple]:
    """(place, score) of the best right name among ``at``: score, then (if so asked) the longer, then the least id."""
    if len(at) > FEW:
        at = at[measure.rough(a, i, b, at) - less[at] >= cutoff - _SLACK]
    if not len(at):
        return []
    bound = measure.bound(a, i, b, at) - less[at] if len(at) > FEW else np.full(len(at), np.inf)
    order = np.argsort(-bound, kind="stable")
    best, top = None, cutoff
    for k in order.tolist():
        if bound[k] < top - _SLACK:
            break
        j = int(at[k])
        score = measure.score(a, i, b, j, top + less[j] - _SLACK) - less[j]
        if score >= top - _SLACK and score >= cutoff:
            key = (-score, -b.size[j] if longest else 0, ids[j])
            if best is None or key < best[0]:
                best = key, j, score
                top = max(top, score)
    return [best[1:]] if best else []


def _every(measure, a: Names, i: int, b: Names, at: np.ndarray, less: np.ndarray, cutoff: float, ids: list) -> list[tuple]:
    at = at[measure.rough(a, i, b, at) - less[at] >= cutoff - _SLACK]
    if not len(at):
        return []
    at = at[measure.bound(a, i, b, at) - less[at] >= cutoff - _SLACK]
    scored = ((j, measure.score(a, i, b, j, cutoff + less[j] - _SLACK) - less[j]) for j in at.tolist())
    return [(j, s) for j, s in scored if s >= cutoff]


def _best_by_trie(longest: bool, measure: str, a: Names, own: list[int], b: Names, allowed, less: np.ndarray, cutoff: float, ids: list) -> list[tuple]:
    """(left place, right place, score) of the best right name of each left one, as ``_best`` tells it."""
    out, whole = [], measure == "name"
    batch = max(1, CELLS // max(len(b.text), 1))
    for start in range(0, len(own), batch):
        part = own[start : start + batch]
        common = b.sorted_trie.common([a.sorted[i] for i in part])
        if whole:
            same = b.plain and all(a.text[i] == a.sorted[i] for i in part)
            texts = common if same else b.text_trie.common([a.text[i] for i in part])
        for k, i in enumerate(part):
            at = allowed(i)
            sort = _ratio(common[k, at], a.sorted_size[i] + b.sorted_size[at])
            bound = sort - less[at]
            if whole:
                held = np.zeros(len(b.text), np.int64)
                for w in a.set[i].split():
                    if w in b.holders:
                        held[b.holders[w]] += 1
                # without a common or repeated word sets are as alike as sorted words
                sets = np.where((held[at] > 0) | b.repeats[at] | bool(a.repeats[i]), 100.0, sort)
                bound = 0.55 * sort + 0.25 * sets + 0.20 * NameMeasure._partial(texts[k, at], a.size[i], b.size[at], a.size[i] + b.size[at]) - less[at]
            keep = np.flatnonzero(bound >= cutoff - _SLACK)
            keep = keep[np.argsort(-bound[keep], kind="stable")]
            best, top, done, many = None, cutoff, 0, 8
            while done < len(keep) and bound[keep[done]] >= top - _SLACK:
                some = keep[done : done + many]
                some = some[bound[some] >= top - _SLACK]
                done, many = done + many, min(2 * many, 256)
                scores = _in_full(a, i, b, at[some], sort[some]) if whole else sort[some]
                for j, score in zip(at[some].tolist(), (scores - less[at[some]]).tolist()):
                    if score >= top - _SLACK and score >= cutoff:
                        key = (-score, -b.size[j] if longest else 0, ids[j])
                        if best is None or key < best[0]:
                            best, top = (key, j, score), max(top, score)
            if best:
                out.append((i, *best[1:]))
    return out


def _in_full(a: Names, i: int, b: Names, at: np.ndarray, sort: np.ndarray) -> np.ndarray:
    """``NameMeasure.score`` of many right names."""
    x = a.text[i]
    sets = np.array([similarity.token_set(x, b.text[j]) for j in at.tolist()])
    cut = np.where((np.minimum(a.size[i], b.size[at]) < 0.55 * np.maximum(a.size[i], b.size[at])) & (sets > sort + 15), 0.75, 1.0)
    return np.maximum((0.55 * sort + 0.25 * sets + 0.20 * partials(x, [b.text[j] for j in at.tolist()])) * cut, 0.0)


def _pairs_by_trie(a: Names, own: list[int], b: Names, allowed, less: np.ndarray, cutoff: float) -> list[tuple]:
    """(left place, right place, score) of all pairs of sorted words with a score of ``cutoff`` or more."""
    out, least = [], cutoff + float(less.min())
    batch = max(1, CELLS // max(len(b.text), 1))
    for start in range(0, len(own), batch):
        part = own[start : start + batch]
        if 0 < least <= 100:
            k, j, common = b.sorted_trie.near([a.sorted[i] for i in part], least)
        elif least > 100:
            continue
        else:
            common = b.sorted_trie.common([a.sorted[i] for i in part])
            k, j = np.indices(common.shape).reshape(2, -1)
            common = common.reshape(-1)
        i = np.array(part, np.int64)[k]
        score = _ratio(common, a.sorted_size[i] + b.sorted_size[j]) - less[j]
        good = score >= cutoff
        if allowed is not None:
            fits = {x: set(allowed(x).tolist()) for x in set(i[good].tolist())}
            out += [(x, y, s) for x, y, s in zip(i[good].tolist(), j[good].tolist(), score[good].tolist()) if y in fits[x]]
        else:
            out += zip(i[good].tolist(), j[good].tolist(), score[good].tolist())
    return out


def alike_texts(left: list[str], right: list[str], cutoff: float) -> list[tuple]:
    """(left place, right place, likeness of sorted words) of all pairs that reach a cutoff over 0; for the few names of one task."""
    if not left or not right:
        return []
    if len(left) * len(right) > MANY:
        a, b = Names(left), Names(right)
        short = [i for i in range(len(left)) if a.size[i] <= BITS]
        out, rest = _pairs_by_trie(a, short, b, None, np.zeros(len(right)), cutoff), set(range(len(left))).difference(short)
    else:
        out, rest = [], range(len(left))
    others = [" ".join(sorted(y.split())) for y in right]
    for i in rest:
        x = " ".join(sorted(left[i].split()))
        m, full, masks = len(x), (1 << len(x)) - 1, {}
        for k, c in enumerate(x):
            masks[c] = masks.get(c, 0) | 1 << k
        for j, y in enumerate(others):
            n = len(y)
            least = cutoff * (m + n) / 200 - _SLACK  # that many characters must be common
            if min(m, n) < least:
                continue
            row = full
            for k in range(0, n, 8):
                for c in y[k : k + 8]:
                    u = row & masks.get(c, 0)
                    row = ((row + u) | (row - u)) & full
                if m - row.bit_count() + max(n - k - 8, 0) < least:
                    break
            else:
                s = 200.0 * (m - row.bit_count()) / (m + n) if m + n else 100.0
                if s >= cutoff:
                    out.append((i, j, s))
    return out


def _search(measure: str, cutoff: float, pick, id_type: pa.DataType):
    """Matches of each chunk in each part. Rows come sorted by block, chunk, part and side."""
    schema = pa.schema([("left_rep", id_type[0]), ("right_rep", id_type[1]), ("score", pa.float64())])

    def told(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    def found(left: list, right: list) -> list[tuple]:
        rows = []
        if left and right:
            a, b = Names([r[0] for r in left]), Names([r[0] for r in right])
            ids, less = [r[4] for r in right], np.array([r[5] for r in right])
            kinds = np.array([r[1] for r in right])
            one = len(set(r[1] for r in left) | set(kinds.tolist())) == 1 and not any(r[2] for r in left)
            sets, year_no = (None, None) if one else np.unique([r[2] for r in right], return_inverse=True)
            every = np.arange(len(right))
            allowed = lambda i: every if one else np.flatnonzero(_allowed(left[i][1], left[i][2], kinds, year_no, sets.tolist()))
            by_trie = [i for i in range(len(left)) if len(left) * len(right) > MANY and a.size[i] <= BITS and (pick is not _every or measure == "sort")]
            if by_trie and pick is _every:
                rows += [(left[i][3], ids[j], s) for i, j, s in _pairs_by_trie(a, by_trie, b, None if one else allowed, less, cutoff)]
            elif by_trie:
                rows += [(left[i][3], ids[j], s) for i, j, s in _best_by_trie(pick.args[0], measure, a, by_trie, b, allowed, less, cutoff, ids)]
            rest = set(range(len(left))).difference(by_trie)
            for i in sorted(rest):
                at = allowed(i)
                if len(at):
                    rows += [(left[i][3], ids[j], s) for j, s in pick(MEASURES[measure], a, i, b, at, less, cutoff, ids)]
        return rows

    def run(batches):
        at, sides, rows = None, ([], []), []
        for batch in batches:
            for group, side, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if group != at:
                    rows += found(*sides)
                    if len(rows) > 10_000:
                        yield told(rows)
                        rows = []
                    at, sides = group, ([], [])
                sides[side].append(row)
        yield told(rows + found(*sides))

    return run


def structure(name: Column) -> tuple[Column, Column]:
    """What must agree: whether a name is of a fund of funds, else whether of an exchange-traded fund; and the years that it names."""
    kind = F.when(name.rlike(r"(?i)\bfof\b|fund of funds"), "fof").when(name.rlike(r"(?i)\betf\b|exchange traded"), "etf").otherwise("")
    return kind, F.array_join(F.array_sort(F.array_distinct(F.coalesce(F.regexp_extract_all(name, F.lit(r"\b(20\d\d)\b"), F.lit(1)), F.array().cast("array<string>")))), ",")


def _matched(left: DataFrame, right: DataFrame, block: str, cutoff: float, measure: str, pick, strict: bool, chunk: int, part: int) -> DataFrame:
    """(id, other, score): left and right hold id, block and name; right may hold ``less``, taken off its scores."""

    def prepared(d: DataFrame) -> DataFrame:
        kind, years = structure(F.col("name")) if strict else (F.lit(""), F.lit(""))
        less = F.col("less") if "less" in d.columns else F.lit(0.0)
        return d.select("id", F.col(block).alias("block"), text.norm_text(F.coalesce("name", F.lit(""))).alias("norm"), kind.alias("kind"), years.alias("years"), less.alias("less"))

    same = ["block", "norm", "kind", "years", "less"]
    a, b = prepared(left), prepared(right)
    reps = [d.groupBy(*same).agg(F.min("id").alias("rep")) for d in (a, b)]
    sizes = [d.groupBy("block").agg(F.count("*").alias(n)) for d, n in zip(reps, ("n_left", "n_right"))]
    size = merged(sizes[0].join(merged(sizes[1]), "block"))
    n_i, n_j = (F.ceil(F.col(c) / F.lit(float(k))).cast("int") for c, k in (("n_left", chunk), ("n_right", part)))
    sides = []
    for side, (d, own, other) in enumerate(zip(reps, (n_i, n_j), (n_j, n_i))):
        d = d.join(size, "block").withColumn("own", F.pmod(F.xxhash64("norm", "kind", "years"), own).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), other - 1)))
        i, j = ("own", "other") if side == 0 else ("other", "own")
        group = F.concat_ws("/", F.col("block").cast("string"), F.col(i), F.col(j))
        columns = [group.alias("group"), F.lit(side).alias("side"), "norm", "kind", "years", *[(F.col("rep") if side == k else F.lit(None).cast(r.schema["rep"].dataType)).alias(n) for k, (n, r) in enumerate(zip(("left_rep", "right_rep"), reps))], "less"]
        sides.append(d.select(*columns))
    types = tuple(pa.string() if dict(r.dtypes)["rep"] == "string" else pa.int64() for r in reps)
    names = ["string" if t == pa.string() else "long" for t in types]
    rows = sides[0].unionByName(sides[1]).withColumns({n: F.col(n).cast(t) for n, t in zip(("left_rep", "right_rep"), names)})
    tasks = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), a.sparkSession.sparkContext.defaultParallelism)
    # a number of tasks: by bytes, many small blocks would go to one
    rows = rows.repartition(tasks, "group").sortWithinPartitions("group", "side").select("group", "side", "norm", "kind", "years", "left_rep", "right_rep", "less")
    found = rows.mapInArrow(_search(measure, cutoff, pick, types), f"left_rep {names[0]}, right_rep {names[1]}, score double")
    back = a.join(merged(reps[0]), same).select("id", F.col("rep").alias("left_rep"))
    found = back.join(merged(found), "left_rep")
    if pick is not _every:
        return found.select("id", F.col("right_rep").alias("other"), "score")
    return found.join(merged(b.join(merged(reps[1]), same).select(F.col("id").alias("other"), F.col("rep").alias("right_rep"))), "right_rep").select("id", "other", "score")


def best_alike(left: DataFrame, right: DataFrame, block: str, cutoff: float, measure: str = "name", strict: bool = True, longest: bool = True, chunk: int = CHUNK, part: int = PART) -> DataFrame:
    """(id, other, score): each left name's best right one of its block, with a score of ``cutoff`` or more.

    Ties: the longer name (with ``longest``), then the least id. ``strict``: names of different structure don't meet. ``right`` may hold
    ``less``, taken off its scores. A null name is empty; a null block meets nothing; ids are whole numbers or strings,
    each once on its side.
    """
    found = _matched(left, right, block, cutoff, measure, partial(_best, longest), strict, chunk, part)
    # one row for each part of a block
    size = F.length(text.norm_text(F.coalesce("name", F.lit("")))) if longest else F.lit(0)
    named = found.join(merged(right.select(F.col("id").alias("other"), size.alias("size"))), "other")
    best = named.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("down"), -F.col("size"), "other")).alias("x"))
    return best.select("id", "x.other", (-F.col("x.down")).alias("score"))


def alike_pairs(left: DataFrame, right: DataFrame, block: str, cutoff: float, measure: str = "sort", strict: bool = False, chunk: int = CHUNK, part: int = PART) -> DataFrame:
    """(id, other, score): all pairs of a block with a score of ``cutoff`` or more; the rest as in ``best_alike``."""
    return _matched(left, right, block, cutoff, measure, _every, strict, chunk, part)


def greedy(edges: DataFrame, group: str) -> DataFrame:
    """One-to-one matches inside each group: the edge of highest score, then of least id and other, is taken as long as both ends are free.

    edges: group, id, other, score. The order is total, so the matching is the only stable one. A group's edges are
    streamed; its free ends are held.
    """
    names = [group, "id", "other", "score"]
    types = dict(edges.dtypes)

    def run(batches):
        at, used, partners = None, set(), set()
        for b in batches:
            keep = []
            for k, (g, x, y, _) in enumerate(zip(*(c.to_pylist() for c in b.columns))):
                if g != at:
                    at, used, partners = g, set(), set()
                if x not in used and y not in partners:
                    used.add(x)
                    partners.add(y)
                    keep.append(k)
            yield b.take(pa.array(keep, pa.int64()))

    rows = edges.select(*names).repartition(group).sortWithinPartitions(group, F.col("score").desc(), "id", "other")
    return rows.mapInArrow(run, ", ".join(f"`{n}` {types[n]}" for n in names))
