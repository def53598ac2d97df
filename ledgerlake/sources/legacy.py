"""Older binary workbooks (compound files of records): sheets of cell texts, dates as ISO days. Bytes in, rows out; called inside tasks."""

from __future__ import annotations

import re
import struct
from datetime import datetime, timedelta

MAGIC = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"
_END = 0xFFFFFFFA  # sector numbers from here on are marks
# Number formats that the file format itself defines as dates
DATE_FORMATS = frozenset([*range(14, 18), 22, *range(27, 37), *range(50, 59)])


def _chain(table: list[int], start: int) -> list[int]:
    """The sectors of a stream; a chain that doesn't end is a damaged file."""
    out, seen = [], set()
    while start < _END:
        if start in seen or start >= len(table):
            raise ValueError("a sector chain is damaged")
        seen.add(start)
        out.append(start)
        start = table[start]
    return out


def stream(content: bytes, names: tuple[str, ...] = ("Workbook",)) -> bytes:
    """A named stream of a compound file."""
    if content[:8] != MAGIC or len(content) < 512:
        raise ValueError("not a compound file")
    size, small = 1 << struct.unpack_from("<H", content, 30)[0], 1 << struct.unpack_from("<H", content, 32)[0]
    directory, cutoff, mini, more = struct.unpack_from("<I", content, 48)[0], *struct.unpack_from("<II", content, 56), struct.unpack_from("<I", content, 68)[0]
    sector = lambda n: content[(n + 1) * size : (n + 2) * size]
    whole = lambda table, start: b"".join(sector(n) for n in _chain(table, start))
    numbers = lambda raw: list(struct.unpack(f"<{len(raw) // 4}I", raw[: len(raw) // 4 * 4]))
    tables, seen = numbers(content[76:512]), 0
    while more < _END and seen * size < len(content):  # further lists of the tables' sectors
        listed = numbers(sector(more))
        tables, more, seen = tables + listed[:-1], listed[-1], seen + 1
    table = numbers(b"".join(sector(n) for n in tables if n < _END))
    entries = whole(table, directory)
    found, root = None, (0xFFFFFFFE, 0)
    for at in range(0, len(entries) - 127, 128):
        length, kind = struct.unpack_from("<HB", entries, at + 64)
        begin, bytes_ = struct.unpack_from("<IQ", entries, at + 116)
        if kind == 5:
            root = begin, bytes_
        elif kind == 2 and entries[at : at + max(length - 2, 0)].decode("utf-16-le", "replace") in names:
            found = begin, bytes_ & 0xFFFFFFFF
    if found is None:
        raise ValueError("no workbook inside")
    if found[1] >= cutoff:
        return whole(table, found[0])[: found[1]]
    held, places = whole(table, root[0]), numbers(whole(table, mini)) if mini < _END else []
    return b"".join(held[n * small : (n + 1) * small] for n in _chain(places, found[0]))[: found[1]]


def records(data: bytes, at: int = 0):
    """(kind, list of segments) of the records from a place on, continued ones together, to the end of the part."""
    held = None
    while at + 4 <= len(data):
        kind, n = struct.unpack_from("<HH", data, at)
        body = data[at + 4 : at + 4 + n]
        at += 4 + n
        if kind == 0x3C and held:
            held[1].append(body)
            continue
        if held:
            yield held
        held = (kind, [body])
        if kind == 0x0A:
            break
    if held:
        yield held


class _Segments:
    """Reads on over a record's continuations; characters that go on begin with a byte that tells their width."""

    def __init__(self, parts: list[bytes]):
        self.parts, self.part, self.at = parts, 0, 0

    def raw(self, n: int) -> bytes:
        out = b""
        while n and self.part < len(self.parts):
            got = self.parts[self.part][self.at : self.at + n]
            out, n, self.at = out + got, n - len(got), self.at + len(got)
            if n:
                self.part, self.at = self.part + 1, 0
        return out

    def number(self, form: str) -> int:
        n = struct.calcsize(form)
        return struct.unpack(form, self.raw(n).ljust(n, b"\0"))[0]

    def text(self, count: int) -> str:
        """A string's flags, characters, and what follows them."""
        flags = self.number("<B")
        runs, extra = self.number("<H") if flags & 8 else 0, self.number("<I") if flags & 4 else 0
        out, wide = "", flags & 1
        while count and self.part < len(self.parts):
            width = 2 if wide else 1
            left = (len(self.parts[self.part]) - self.at) // width
            take = min(count, left)
            out += self.raw(take * width).decode("utf-16-le" if wide else "latin-1", "replace")
            count -= take
            if count:
                self.part, self.at = self.part + 1, 0
                if self.part < len(self.parts):
                    wide = self.number("<B") & 1
        self.raw(4 * runs + extra)
        return out


def is_date_format(number: int, text: str) -> bool:
    """Whether a number format shows a day: one of the fixed ones, or a text with day or year marks outside quotes and brackets."""
    bare = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.|[_*].', "", text).lower()
    return number in DATE_FORMATS or (bool(re.search(r"[dy]", bare)) and "general" not in bare)


def _shown(value: float, dated: bool, since_1904: bool) -> str:
    if dated and 1 <= value < 2_958_466:
        day = (datetime(1904, 1, 1) if since_1904 else datetime(1899, 12, 30)) + timedelta(days=value)
        return day.date().isoformat() if value == int(value) else day.isoformat(sep=" ", timespec="seconds")
    return str(int(value)) if value == int(value) and abs(value) < 1e15 else repr(value)


def _packed(rk: int) -> float:
    """A number in 30 bits: an integer or a double's head, perhaps of hundredths."""
    value = float((rk - (1 << 32) if rk >> 31 else rk) >> 2) if rk & 2 else struct.unpack("<d", struct.pack("<Q", (rk & 0xFFFFFFFC) << 32))[0]
    return value / 100 if rk & 1 else value


def sheets(content: bytes, max_rows: int = 20_000, max_cols: int = 80) -> list[tuple[str, list[list[str]]]]:
    """(sheet, rows of cell texts): values only, whole numbers without a fraction, days as ISO dates."""
    data = stream(content)
    tabs, shared, formats, styles, since_1904 = [], [], {}, [], False
    for kind, parts in records(data):
        r = _Segments(parts)
        if kind == 0x85:
            place, _, type_ = r.number("<I"), r.number("<B"), r.number("<B")
            if type_ == 0:
                tabs.append((place, r.text(r.number("<B"))))
        elif kind == 0x22:
            since_1904 = bool(r.number("<H"))
        elif kind == 0x41E:
            number = r.number("<H")
            formats[number] = r.text(r.number("<H"))
        elif kind == 0xE0:
            styles.append(struct.unpack_from("<H", parts[0], 2)[0])
        elif kind == 0xFC:
            r.raw(4)
            shared = [r.text(r.number("<H")) for _ in range(min(r.number("<I"), len(data)))]
    dated = [is_date_format(n, formats.get(n, "")) for n in styles]
    out = []
    for place, name in tabs:
        rows: list[list[str]] = []
        waits = None  # the cell of a formula whose text comes in the next record

        def put(row: int, col: int, text: str, rows=rows) -> None:
            if row < max_rows and col < max_cols:
                rows.extend([] for _ in range(row + 1 - len(rows)))
                rows[row].extend([""] * (col + 1 - len(rows[row])))
                rows[row][col] = text.strip()

        for kind, parts in records(data, place):
            body = parts[0]
            if kind == 0x207 and waits:
                put(*waits, (s := _Segments(parts)).text(s.number("<H")))
            if kind not in (0xFD, 0x203, 0x27E, 0xBD, 0x204, 0x06, 0x205) or len(body) < 6:
                continue
            row, col, style = struct.unpack_from("<HHH", body)
            number = lambda v, style=style: _shown(v, style < len(dated) and dated[style], since_1904)
            if kind == 0xFD:
                at = struct.unpack_from("<I", body, 6)[0]
                put(row, col, shared[at] if at < len(shared) else "")
            elif kind == 0x203:
                put(row, col, number(struct.unpack_from("<d", body, 6)[0]))
            elif kind == 0x27E:
                put(row, col, number(_packed(struct.unpack_from("<I", body, 6)[0])))
            elif kind == 0xBD:
                for k in range((len(body) - 6) // 6):
                    one, rk = struct.unpack_from("<HI", body, 4 + 6 * k)
                    put(row, col + k, number(_packed(rk), one))
            elif kind == 0x204:
                s = _Segments(parts)
                s.raw(6)
                put(row, col, s.text(s.number("<H")))
            elif kind == 0x205:
                put(row, col, "" if body[7] else str(body[6]))
            elif body[12:14] != b"\xff\xff":
                put(row, col, number(struct.unpack_from("<d", body, 6)[0]))
            elif body[6] == 1:
                put(row, col, str(body[8]))
            waits = (row, col) if kind == 0x06 and body[12:14] == b"\xff\xff" and body[6] == 0 else None
        out.append((name, rows))
    return out
