"""Personal data: the base patterns, and more spans from a conditional random field over word shapes.

Base spans (e-mail, IP address, card and phone numbers) come from fixed patterns, leftmost and without overlap
per kind; matches that fail their check are dropped. The field (``crf``) labels every word of every line; its
spans are kept where they touch no base span and pass their kind's check (digits, Luhn), which adds phone
numbers without a plus, spelled-out e-mail addresses, and a kind of its own, ``secret``: codes assigned to a
password, token or key. Positions are code points, ends exclusive.

Defined cases: null is empty and has no spans; repeated rows are judged alike; spans of one start stand in the order
of their kinds, labels of equal score are the first listed; long lines are cut between plain words for decoding, and
a very long text is a slice of its own; an empty table gives no rows;
``redact`` leaves a null text null and keeps all other columns, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C
from . import crf

KINDS = crf.KINDS
BASE = KINDS[:4]
PIECE = 64
OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_LETTER = re.compile(r"[A-Za-z]")
_LABEL = re.compile(r"[a-z0-9._%+-]+")
_ASSIGNED = re.compile(rb"[A-Za-z_-]+[=:]+[\"']?")
_AFTER = re.compile(rb"[^A-Za-z0-9+/=_-]+\Z")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(t: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, t.find("@")
    while at >= 0:
        s = at
        while s > end and _LOCAL.match(t, s - 1):
            s -= 1
        m = _DOMAIN.match(t, at + 1) if s < at else None
        if m:
            out.append((s, end := m.end()))
        else:
            end = at + 1  # no later match can hold this sign or anything before it
        at = t.find("@", max(at + 1, end))
    return out


def base_spans(t: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all base spans, by start and kind."""
    found = [(s, e, "email") for s, e in _emails(t)]
    if _DIGITS.search(t):
        for m in _IP.finditer(t):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                found.append((*m.span(), "ip"))
        for m in _CARD.finditer(t):
            if m.end() - m.start() >= 12:
                d = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(d) <= 19 and luhn(d):
                    found.append((*m.span(), "card"))
        if "+" in t:
            for m in _PHONE.finditer(t):
                if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
                    found.append((*m.span(), "phone"))
    return sorted(found, key=_order)


def _order(x: tuple[int, int, str]):
    return x[0], KINDS.index(x[2]), x[1]


@functools.cache
def model() -> tuple[np.ndarray, np.ndarray]:
    return crf.train(crf.labelled_table())


def labels(cls: np.ndarray, line: np.ndarray, w: np.ndarray, tr: np.ndarray) -> np.ndarray:
    """Viterbi labels of words with shape classes ``cls``; ``line`` numbers their lines. Long lines are cut between plain words."""
    n = len(cls)
    if n == 0:
        return np.zeros(0, np.int8)
    cut = np.zeros(n, bool)
    cut[0] = True
    new = line[1:] != line[:-1]
    cut[1:] = new
    plain = np.flatnonzero((cls[1:] <= 2) & (cls[:-1] <= 2)) + 1
    cut[plain[np.unique(plain // PIECE, return_index=True)[1]]] = True
    s = np.flatnonzero(cut)
    size = np.diff(np.append(s, n))
    # emissions see the words around a word in its own line, across cuts
    score = np.zeros((n, crf.N_LABELS), np.float32)
    for k, o in enumerate(crf.OFFSETS):
        at = np.arange(n) + o
        ok = (at >= 0) & (at < n)
        at = np.clip(at, 0, n - 1)
        ok &= line[at] == line
        score += w[k][np.where(ok, cls[at], 0)]
    out = np.zeros(n, np.int8)
    order = np.argsort(size, kind="stable")
    i = 0
    start = crf._START.astype(np.float32)
    while i < len(order):
        j = i + 1
        while j < len(order) and (j + 1 - i) * size[order[j]] <= 200_000 and size[order[j]] <= 2 * size[order[i]] + 8:
            j += 1
        rows = order[i:j]
        width = int(size[rows[-1]])
        at = np.minimum(s[rows][:, None] + np.arange(width), n - 1)
        live = np.arange(width) < size[rows][:, None]
        e = score[at]
        best = e[:, 0] + start
        back = np.zeros((len(rows), width, crf.N_LABELS), np.int8)
        for t in range(1, width):
            into = best[:, :, None] + tr
            a = into.argmax(1)
            back[:, t] = a
            best = np.where(live[:, t, None], np.take_along_axis(into, a[:, None], 1)[:, 0] + e[:, t], best)
        now, r = best.argmax(1), np.arange(len(rows))
        for t in range(width - 1, -1, -1):
            out[at[live[:, t], t]] = now[live[:, t]]
            if t:
                now = np.where(live[:, t], back[r, t, now], now)
        i = j
    return out


def _passes(kind: str, text: str) -> bool:
    d = "".join(_DIGITS.findall(text))
    if kind == "card":
        return 12 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 9 <= len(d) <= 15
    if kind == "ip":
        return bool(_IP.fullmatch(text)) and all(int(p) <= 255 for p in text.split("."))
    if kind == "secret":
        return len(text) >= 8 and bool(_DIGITS.search(text)) and bool(_LETTER.search(text)) and " " not in text
    if "@" in text:
        return "." in text.split("@")[1]
    words = text.lower().split()  # local at label (dot label)+
    return len(words) >= 5 and len(words) % 2 == 1 and words[1] in crf.CUES["at"] and all(x in crf.CUES["dot"] for x in words[3::2]) and all(_LABEL.fullmatch(x) for x in words[::2]) and words[-1].isalpha()


def field_spans(data: np.ndarray, offsets: np.ndarray, w: np.ndarray, tr: np.ndarray) -> dict[int, list[tuple[int, int, str]]]:
    """The field's spans by document index, in code points."""
    starts, ends, first = C.words(data, offsets)
    breaks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 10, out=breaks[1:])
    doc = C.owner(first)
    line = breaks[starts] + doc  # a document's end is a line's end
    got = labels(crf.shapes(data, starts, ends), line, w, tr)
    hit = np.flatnonzero(got)
    if len(hit) == 0:
        return {}
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    out: dict[int, list] = {}
    runs = []
    for i in hit.tolist():
        name = crf.LABELS[got[i]]
        if name[0] == "I" and runs and runs[-1][1] == i - 1 and runs[-1][2] == name[2:]:
            runs[-1][1] = i
        else:
            runs.append([i, i, name[2:]])
    raw = data.tobytes()
    for a, b, kind in runs:
        s, e = int(starts[a]), int(ends[b])
        while e > s and raw[e - 1] in b".,;:!?\"')]>":
            e -= 1
        while s < e and raw[s] in b"\"'[<":
            s += 1
        if kind == "secret":  # what is assigned, without the name and further marks
            m = _ASSIGNED.match(raw, s, e)
            s = m.end() if m else s
            m = _AFTER.search(raw[s:e])
            e = s + m.start() if m else e
        if s < e and _passes(kind, raw[s:e].decode("utf-8", "ignore")):
            d = int(doc[a])
            zero = chars[offsets[d]]
            out.setdefault(d, []).append((int(chars[s] - zero), int(chars[e] - zero), kind))
    return out


def all_spans(texts: list[str], data: np.ndarray, offsets: np.ndarray, w: np.ndarray, tr: np.ndarray):
    """(base spans, all spans) of every text."""
    more = field_spans(data, offsets, w, tr)
    for i, t in enumerate(texts):
        base = base_spans(t)
        extra = [x for x in more.get(i, ()) if all(x[1] <= s or e <= x[0] for s, e, _ in base)]
        yield base, (sorted(base + extra, key=_order) if extra else base)


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def _slices(b, w, tr):
    column = b.column("text")
    data, offsets = C.text_bytes(column)
    for i, j in C.slices(offsets):
        texts = column.slice(i, j - i).to_pylist()
        yield i, j, texts, all_spans([t or "" for t in texts], data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], w, tr)


def find(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    w, tr = model()

    def run(batches):
        for b in batches:
            for i, j, _, found in _slices(b, w, tr):
                cols = {name.split()[0]: [] for name in OUT.split(", ")[1:]}
                for base, spans in found:
                    kinds = [k for _, _, k in base]
                    for k in BASE:
                        cols[f"n_{k}"].append(kinds.count(k))
                    cols["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                    cols["spans"].append(_joined(spans))
                yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id").slice(i, j - i).cast(pa.int64())} | {k: pa.array(v, pa.string() if k in ("base_sha256", "spans") else pa.int64()) for k, v in cols.items()})

    return docs.select("doc_id", "text").mapInArrow(C.released(run), OUT)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; where a span overlaps one before it, the two are replaced together. ``n_chars`` follows."""
    w, tr = model()
    names = docs.columns

    def run(batches):
        for b in batches:
            for i, j, texts, found in _slices(b, w, tr):
                new = []
                for t, (_, spans) in zip(texts, found):
                    if spans:
                        out, end = [], 0
                        for s, e, k in spans:
                            if s >= end:
                                out += [t[end:s], f"<{k.upper()}>"]
                            end = max(end, e)
                        t = "".join([*out, t[end:]])
                    new.append(t)
                part = b.slice(i, j - i)
                cols = [pa.array(new, c.type) if n == "text" else pa.array([None if x is None else len(x) for x in new], c.type) if n == "n_chars" else c for n, c in zip(names, part.columns)]
                yield pa.RecordBatch.from_arrays(cols, schema=part.schema)

    return docs.mapInArrow(C.released(run), docs.schema)
