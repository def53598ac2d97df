"""Nested listings (JSON trees of any depth, JSON inside scripts) as rows."""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame

FILE = re.compile(r"\.(?:xlsx?|xlsb|zip|csv|pdf)(?:$|\?)", re.I)
OUT = "id long, pos int, path string, title string, url string"
TITLES = ("title", "name", "label", "text", "documentName")


def balanced(text: str, start: int) -> str | None:
    """The bracketed value that opens at or after ``start``; brackets inside strings don't count."""
    m = re.compile(r"[\[{]").search(text, start)
    if not m:
        return None
    depth, quote, skip = 0, "", False
    for i in range(m.start(), len(text)):
        c = text[i]
        if quote:
            if skip:
                skip = False
            elif c == "\\":
                skip = True
            elif c == quote:
                quote = ""
        elif c in "\"'":
            quote = c
        elif c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
            if depth == 0:
                return text[m.start() : i + 1]
    return None


def value_after(text: str, marker: str):
    """The JSON value after a marker (a variable's or key's name), or null."""
    at = (text or "").find(marker)
    raw = balanced(text, at + len(marker)) if at >= 0 else None
    if raw is None:
        return None
    for candidate in (raw, raw.replace('\\"', '"')):
        try:
            return json.loads(candidate)
        except ValueError:
            continue
    return None


def walk(tree, path: tuple[str, ...] = ()):
    """(path, title, url) of every file in a tree; lists and envelopes are passed through, names build the path."""
    if isinstance(tree, list):
        for x in tree:
            yield from walk(x, path)
    elif isinstance(tree, dict):
        title = next((tree[k] for k in TITLES if isinstance(tree.get(k), str)), None)
        here = (*path, title) if title else path
        for v in tree.values():
            if isinstance(v, str) and FILE.search(v):
                yield "/".join(path), title, v
            elif isinstance(v, (dict, list)):
                yield from walk(v, here)


def files(df: DataFrame, key: str, text: str, marker: str | None = None) -> DataFrame:
    """(id, pos, path, title, url) of the files in a JSON column, or in the JSON after a marker in it; what doesn't parse gives none."""

    def run(batches):
        for b in batches:
            rows = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if marker:
                    tree = value_after(t or "", marker)
                else:
                    try:
                        tree = json.loads(t or "null")
                    except ValueError:
                        tree = None
                rows += [(k, i, *x) for i, x in enumerate(walk(tree))]
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()))], ["id", "pos", "path", "title", "url"])

    return df.select(key, text).mapInArrow(run, OUT)
