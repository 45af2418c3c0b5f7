"""Nested comment trees of payloads as flat rows: each text is read once, whatever its depth.

A payload holds its whole tree in one text, so no rows are moved. The text is parsed once and
the tree is walked with a stack of positions, so the work grows with the bytes of the text alone;
nothing below a node is read again for the levels above it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa

FLUSH_VALUES = 200_000  # values of nodes, with the steps of their paths, held before they go on
LONG = 1 << 63

_TOKEN = re.compile(r'[ \t\n\r]*([\[\]{},:]|"(?:[^"\\]|\\.)*"|[^\s\[\]{},:"]+)', re.S)


def loads_deep(text: str):
    """``json.loads`` with a list as its stack, for texts nested deeper than that can go."""
    whole: list = []
    open_: list = [whole]  # containers that are not closed yet
    names: list = [None]  # in each, the name that waits for its value
    want, at = "value", 0  # value, first (value or close), name, colon, after
    end = len(text.rstrip(" \t\n\r"))
    while at < end:
        found = _TOKEN.match(text, at)
        if found is None:
            raise ValueError(f"not JSON at {at}")
        token, at = found[1], found.end()
        top = open_[-1]
        if token in "]}":
            kind = dict if token == "}" else list
            if len(open_) == 1 or type(top) is not kind or want not in ("after", "first"):
                raise ValueError(f"not JSON at {at}")
            open_.pop(), names.pop()
            want = "after"
        elif token == ",":
            if want != "after" or len(open_) == 1:
                raise ValueError(f"not JSON at {at}")
            want = "name" if type(top) is dict else "value"
        elif token == ":":
            if want != "colon":
                raise ValueError(f"not JSON at {at}")
            want = "value"
        elif type(top) is dict and want in ("first", "name"):
            names[-1], want = json.loads(token), "colon"
            if type(names[-1]) is not str:
                raise ValueError(f"not JSON at {at}")
        elif want in ("value", "first"):
            value = {} if token == "{" else [] if token == "[" else json.loads(token)
            if type(top) is dict:
                top[names[-1]] = value
            else:
                top.append(value)
            want = "after"
            if token in "{[":
                open_.append(value), names.append(None)
                want = "first"
        else:
            raise ValueError(f"not JSON at {at}")
    if len(open_) > 1 or want != "after":
        raise ValueError("JSON ends early")
    return whole[0]


def parse(text: str | None):
    """The value of a JSON text; None if it is none."""
    try:
        return json.loads(text or "")
    except RecursionError:
        try:
            return loads_deep(text)
        except ValueError:
            return None
    except ValueError:
        return None


def _text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _long(value) -> int | None:
    return value if type(value) is int and -LONG <= value < LONG else None


def _inside(value, name: str):
    return value.get(name) if isinstance(value, dict) else None


def nodes(tree, listed: str, below: str) -> Iterator[tuple[list[int], dict]]:
    """(path, node) in pre-order; children that are no objects keep their number but give no row."""
    roots = _inside(tree, listed)
    stack = [iter(enumerate(roots))] if isinstance(roots, list) else []
    path: list[int] = []
    while stack:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if path:
                path.pop()
            continue
        number, node = step
        if not isinstance(node, dict):
            continue
        path.append(number)
        yield list(path), node
        children = node.get(below)
        stack.append(iter(enumerate(children)) if isinstance(children, list) else iter(()))


FIELDS = pa.schema(
    [
        ("path", pa.list_(pa.int32())),
        ("depth", pa.int32()),
        ("author", pa.string()),
        ("content", pa.string()),
        ("upvotes", pa.int64()),
        ("downvotes", pa.int64()),
        ("created_at", pa.string()),
    ]
)


def flatten(
    batches: Iterator[pa.RecordBatch], listed: str, below: str
) -> Iterator[pa.RecordBatch]:
    """Batches of (key, body) to batches of (key, the columns of ``FIELDS``)."""

    def rows() -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(columns, FIELDS)]
        keys = batch.column(0).take(pa.array(owners, pa.int64()))
        return pa.RecordBatch.from_arrays([keys, *arrays], names=[batch.schema.names[0], *FIELDS.names])

    for batch in batches:
        owners, columns, held = [], [[] for _ in FIELDS], 0
        for owner, body in enumerate(batch.column(1)):
            for path, node in nodes(parse(body.as_py()), listed, below):
                values = (
                    path,
                    len(path),
                    _text(_inside(node.get("author"), "name")),
                    _text(node.get("content")),
                    _long(node.get("upvotes")),
                    _long(node.get("downvotes")),
                    _text(node.get("created_at")),
                )
                owners.append(owner)
                for column, value in zip(columns, values):
                    column.append(value)
                held += len(path) + len(FIELDS)
                if held >= FLUSH_VALUES:
                    yield rows()
                    owners, columns, held = [], [[] for _ in FIELDS], 0
        yield rows()
