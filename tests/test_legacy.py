"""Binary workbooks written record by record come back cell by cell."""

import struct

import pytest

from ledgerlake.sources import legacy, workbook

END, FREE, TABLE = 0xFFFFFFFE, 0xFFFFFFFF, 0xFFFFFFFD


def compound(data, name="Workbook"):
    """A compound file with one stream, in the small stream where it is short."""
    small = len(data) < 4096
    sectors, table = [], []

    def add(raw, mark=None):
        """Sectors of a stream, chained; returns the first."""
        n = max(1, -(-len(raw) // 512))
        first = len(sectors)
        for k in range(n):
            sectors.append(raw[512 * k : 512 * k + 512].ljust(512, b"\0"))
            table.append(mark if mark is not None else first + k + 1 if k + 1 < n else END)
        return first

    entry = lambda n, kind, start, size: n.encode("utf-16-le").ljust(64, b"\0") + struct.pack("<HBB", 2 * len(n) + 2, kind, 1) + struct.pack("<III", FREE, FREE, 1 if kind == 5 else FREE) + b"\0" * 36 + struct.pack("<IQ", start, size)
    mini, held = END, (END, 0)
    if small:
        n = -(-len(data) // 64)
        held = add(data.ljust(64 * n, b"\0")), 64 * n
        mini = add(struct.pack(f"<{n}I", *[*range(1, n), END]).ljust(512, b"\xff"))
        start = 0
    else:
        start = add(data)
    directory = add(entry("Root Entry", 5, *held) + entry(name, 2, start, len(data)) + b"\0" * 256)
    fats = 1
    while fats * 128 < len(sectors) + fats:
        fats += 1
    first = len(sectors)
    table += [TABLE] * fats
    fat = struct.pack(f"<{len(table)}I", *table).ljust(512 * fats, b"\xff")
    header = legacy.MAGIC + b"\0" * 16 + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + b"\0" * 10 + struct.pack("<IIIIIIIII", fats, directory, 0, 4096, mini, int(small), END, 0, first)
    places = struct.pack(f"<{109 - 1}I", *[first + k if k < fats else FREE for k in range(1, 109)])
    return header + places + b"".join(sectors) + fat


rec = lambda kind, body: struct.pack("<HH", kind, len(body)) + body
short = lambda s: struct.pack("<HB", len(s), 0) + s.encode("latin-1")
wide = lambda s: struct.pack("<HB", len(s), 1) + s.encode("utf-16-le")
cell = lambda r, c, x: struct.pack("<HHH", r, c, x)


def book(padding=0):
    strings = ["Name", "हिन्दी fund", "cut across two records", "rich"]
    first = struct.pack("<II", 4, 4) + short(strings[0]) + wide(strings[1]) + struct.pack("<HB", len(strings[2]), 0) + strings[2][:9].encode()
    rest = b"\1" + strings[2][9:].encode("utf-16-le") + struct.pack("<HBH", 4, 8, 1) + b"rich" + b"\0" * 4
    head = rec(0x809, struct.pack("<HH", 0x600, 5)) + rec(0x22, struct.pack("<H", 0)) + rec(0x41E, struct.pack("<H", 164) + short('dd\\-mmm\\-yy "x"')) + rec(0x41E, struct.pack("<H", 165) + short('0.00 "days"'))
    head += b"".join(rec(0xE0, struct.pack("<HH", 0, f) + b"\0" * 16) for f in (0, 14, 164, 165)) + rec(0xFC, first) + rec(0x3C, rest)
    one = rec(0x809, struct.pack("<HH", 0x600, 16)) + rec(0xFD, cell(0, 0, 0) + struct.pack("<I", 0)) + rec(0xFD, cell(0, 2, 0) + struct.pack("<I", 1)) + rec(0xFD, cell(1, 0, 0) + struct.pack("<I", 2)) + rec(0xFD, cell(1, 1, 0) + struct.pack("<I", 3))
    one += rec(0x203, cell(2, 0, 0) + struct.pack("<d", 12.5)) + rec(0x203, cell(2, 1, 1) + struct.pack("<d", 46218)) + rec(0x203, cell(2, 2, 2) + struct.pack("<d", 46218.5)) + rec(0x203, cell(2, 3, 3) + struct.pack("<d", 46218))
    one += rec(0x27E, cell(3, 0, 0) + struct.pack("<I", (1234 << 2) | 3)) + rec(0xBD, struct.pack("<HH", 3, 1) + struct.pack("<HI", 0, ((-7 & 0x3FFFFFFF) << 2) | 2) + struct.pack("<HI", 1, (46218 << 2) | 2) + struct.pack("<H", 2)) + rec(0x204, cell(3, 3, 0) + short(" label "))
    one += rec(0x06, cell(4, 0, 0) + b"\0" + b"\0" * 5 + b"\xff\xff" + b"\0" * 8) + rec(0x207, short("told")) + rec(0x06, cell(4, 1, 0) + struct.pack("<d", 3.0) + b"\0" * 8) + rec(0x06, cell(4, 2, 0) + b"\1\0\1\0\0\0\xff\xff" + b"\0" * 8) + rec(0x205, cell(4, 3, 0) + b"\1\0") + rec(0x205, cell(4, 4, 0) + b"\x07\1")
    one += rec(0x203, cell(70, 90, 0) + struct.pack("<d", 1)) + b"".join(rec(0x203, cell(5, k, 0) + struct.pack("<d", k)) for k in range(padding)) + rec(0x0A, b"")
    two = rec(0x809, struct.pack("<HH", 0x600, 16)) + rec(0x0A, b"")
    sheet = lambda at, n, kind=0: rec(0x85, struct.pack("<IBB", at, 0, kind) + struct.pack("<BB", len(n), 0) + n.encode())
    size = len(head) + sum(len(sheet(0, n)) for n in ("One", "Empty", "Chart")) + 4
    return head + sheet(size, "One") + sheet(size + len(one), "Empty") + sheet(0, "Chart", 2) + rec(0x0A, b"") + one + two


WANT = [["Name", "", "हिन्दी fund"], ["cut across two records", "rich"], ["12.5", "2026-07-15", "2026-07-15 12:00:00", "46218"], ["12.34", "-7", "2026-07-15", "label"], ["told", "3", "1", "1", ""]]


@pytest.mark.parametrize("padding", [0, 60, 79])
def test_cells_come_back(padding):
    data = book(padding)
    got = legacy.sheets(compound(data))
    assert [n for n, _ in got] == ["One", "Empty"] and got[1][1] == []
    assert got[0][1][:5] == WANT and (not padding or got[0][1][5] == [str(k) for k in range(padding)])


def test_long_streams_and_damage(spark):
    data = book() + rec(0x3D, b"\0" * 6000)
    whole = compound(data)
    assert legacy.sheets(whole)[0][1][:5] == WANT
    for bad in (b"", legacy.MAGIC, whole[:600], compound(b"x" * 10, "Other")):
        with pytest.raises((ValueError, struct.error)):
            legacy.sheets(bad)
    loop = bytearray(compound(book()))
    at = loop.rfind(struct.pack("<I", TABLE))
    start = at - at % 512
    loop[start : start + 4] = struct.pack("<I", 0)
    with pytest.raises((ValueError, struct.error)):
        legacy.sheets(bytes(loop))
    files = spark.createDataFrame([("a.xls", compound(book())), ("b.xlsx", compound(book())), ("c.xls", workbook.book_bytes([("X", [["y"]])])), ("d.zip", workbook.archive_bytes([("e.xls", compound(book()))])), ("f.xls", whole[:600])], "path string, content binary")
    grid = workbook.grids(files).collect()
    assert {r.file for r in grid if not r.error} == {"a.xls", "b.xlsx", "c.xls", "d.zip!e.xls"} and [r.file for r in grid if r.error] == ["f.xls"]
    assert [r.cells for r in grid if r.file == "d.zip!e.xls" and r.row_no < 5] == WANT
