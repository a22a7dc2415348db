"""A document's extractor JSON walked in order, in plain Python.

What is JSON, and how values are cast, is as with Spark's variants (``try_parse_json``,
``try_variant_get``): no key twice in an object, no NaN, text after the value is not
read; ``None`` is both null and what cannot be cast. No function here calls itself, so
trees may be as deep as JSON's reader goes.
"""

from __future__ import annotations

import json
import re
from decimal import Decimal

#: Fixed value: node types that hold text.
TEXT_TYPES = frozenset({"paragraph", "heading", "caption", "header", "footer"})
LEAVES = ("table", "image")
# Keys of the extractor's metadata.
METADATA = {"author": "author", "title": "title", "creation_date": "creation date", "modification_date": "modification date"}

_TRIM = "".join(map(chr, range(33))) + "\x7f"
_WHOLE = re.compile(r"[+-]?[0-9]+")
_REAL = re.compile(r"([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)[dDfF]?")
_HEX = re.compile(r"([+-]?0[xX](?:[0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+)[dDfF]?")
_NAMED = {"inf": float("inf"), "+inf": float("inf"), "infinity": float("inf"), "+infinity": float("inf"), "-inf": float("-inf"), "-infinity": float("-inf"), "nan": float("nan")}
_ESCAPES = {i: f"\\u{i:04X}" for i in range(32)} | {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r", 34: '\\"', 92: "\\\\"}


_ESCAPED = re.compile(r"\\(?:u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|(u[dD][89a-fA-F][0-9a-fA-F]{2})|.)", re.DOTALL)


class Number(str):
    """A number with a fraction or an exponent, as it is written."""

    __slots__ = ()


class Misfit(Exception):
    """A value of another kind than its place needs."""


def _object(pairs: list) -> dict:
    found = dict(pairs)
    if len(found) != len(pairs):
        raise ValueError("a key occurs twice")
    return found


def _constant(name: str):
    raise ValueError(f"{name} is no number")


_READER = json.JSONDecoder(parse_float=Number, parse_constant=_constant, object_pairs_hook=_object)


def loads(text: str):
    """The value at the start of a text; ValueError or RecursionError if there is none. Half of a surrogate pair becomes ``?``."""
    if "\\ud" in text or "\\uD" in text:
        text = _ESCAPED.sub(lambda m: "?" if m[1] else m[0], text)
    return _READER.raw_decode(text.lstrip(" \t\r\n"))[0]


def _is_decimal(number: str) -> bool:
    """Whether a number is kept exactly: no exponent, at most 38 digits, also after the point."""
    if "e" in number or "E" in number:
        return False
    before, _, after = number.lstrip("-").partition(".")
    return len((before + after).lstrip("0")) <= 38 and len(after) <= 38


def _java(x: float) -> str:
    """A double as Java writes it."""
    if x != x or x in (float("inf"), float("-inf")):
        return "NaN" if x != x else "Infinity" if x > 0 else "-Infinity"
    if x == 0 or 1e-3 <= abs(x) < 1e7:
        return repr(x) if "e" not in repr(x) else f"{x:f}"
    sign, digits, power = Decimal(repr(x)).as_tuple()
    digits = "".join(map(str, digits))
    power, digits = power + len(digits) - 1, digits.rstrip("0")
    return f"{'-' if sign else ''}{digits[0]}.{digits[1:] or '0'}E{power}"


def _written(x) -> str:
    """A number or truth value as text."""
    if isinstance(x, Number):
        if not _is_decimal(x):
            return _java(float(x))
        text = x.rstrip("0").rstrip(".")
        return "0" if not text.strip("-0.") else text
    if x is None or isinstance(x, bool):
        return {None: "null", True: "true", False: "false"}[x]
    return str(x) if -(10**38) < x < 10**38 else _java(_double(x))


def _double(x) -> float:
    try:
        return float(x)
    except OverflowError:
        return float("inf") if x > 0 else float("-inf")


def _json(value) -> str:
    out, stack = [], [value]
    while stack:
        x = stack.pop()
        if isinstance(x, tuple):  # a part that is written already
            out.append(x[0])
        elif isinstance(x, str) and not isinstance(x, Number):
            out.append(f'"{x.translate(_ESCAPES)}"')
        elif isinstance(x, dict):
            parts = [y for k, v in sorted(x.items(), key=lambda e: e[0].encode("utf-16-be")) for y in ((f'"{k.translate(_ESCAPES)}":',), v, (",",))][:-1]
            stack.extend(reversed([("{",), *parts, ("}",)]))
        elif isinstance(x, list):
            parts = [y for v in x for y in (v, (",",))][:-1]
            stack.extend(reversed([("[",), *parts, ("]",)]))
        else:
            text = _written(x)
            out.append(text if text[-1] not in "yN" else f'"{text}"')
    return "".join(out)


def string(value) -> str | None:
    if type(value) is str or value is None:
        return value
    return _json(value) if isinstance(value, (dict, list)) else _written(value)


def whole(value, bits: int = 64) -> int | None:
    """A whole number; fractions are cut off, but not those of strings."""
    if type(value) is not int:
        if isinstance(value, Number):
            if not _is_decimal(value):
                number = float(value)
                value = int(number) if abs(number) < 2.0**65 else None
                if value == 1 << 63:  # as a double, that is also the largest number
                    value -= 1
            else:
                value = int(value.partition(".")[0])
        elif isinstance(value, str):
            value = value.strip(_TRIM)
            value = int(value) if len(value) < 4000 and _WHOLE.fullmatch(value) else None
        elif isinstance(value, bool):
            value = int(value)
        else:
            return None
    return value if value is not None and -(1 << (bits - 1)) <= value < 1 << (bits - 1) else None


def real(value) -> float | None:
    if type(value) is int or isinstance(value, (Number, bool)):
        return _double(value) or 0.0
    if not isinstance(value, str):
        return None
    value = value.strip(_TRIM)
    if found := _REAL.fullmatch(value):
        return float(found[1])
    if value.lower() in _NAMED or value in ("+NaN", "-NaN"):
        return _NAMED.get(value.lower(), _NAMED["nan"])
    if found := _HEX.fullmatch(value):
        try:
            return float.fromhex(found[1])
        except OverflowError:
            return _NAMED["-inf" if value[0] == "-" else "inf"]
    return None


def count(node: dict, key: str) -> int | None:
    """A whole number; null for none and for 0. One that is no number, or has over 32 bits, is a misfit."""
    value = node.get(key)
    if value is None:
        return None
    n = whole(value)
    if n is None or not -(1 << 31) <= n < 1 << 31:
        raise Misfit
    return n or None


def _list(node, key: str) -> list:
    value = node.get(key) if type(node) is dict else None
    return value if type(value) is list else []


def _listed(node: dict, key: str) -> list:
    """The list of a key, which may be missing but must not be something else."""
    value = node.get(key)
    if value is None:
        return []
    if type(value) is not list:
        raise Misfit
    return value


_NO_BOX = (0.0, 0.0, 0.0, 0.0)


def _box(node: dict) -> tuple:
    """Four numbers; zeros if there is no list of at least four."""
    box = node.get("bounding box")
    if type(box) is not list or len(box) < 4:
        return _NO_BOX
    found = tuple([real(x) for x in box[:4]])
    if None in found:
        raise Misfit
    return found


def _said(cell) -> str:
    """Texts of all nodes below a cell, in order."""
    found, stack = [], _list(cell, "kids")[::-1]
    while stack:
        node = stack.pop()
        if type(node) is dict:
            text = (string(node.get("content")) or "").strip()
            if text:
                found.append(text)
            kids = _list(node, "kids")
            if kids:
                stack.extend(reversed(kids))
    return " ".join(found)


def _grid(table: dict) -> tuple | None:
    """(row_count, col_count, data) of a table that has rows, or both counts; later cells overwrite, cells outside are dropped."""
    rows = _listed(table, "rows")
    n, m = count(table, "number of rows"), count(table, "number of columns")
    if not rows and (n is None or m is None):
        return None
    n = len(rows) if n is None else n
    m = max((len(_list(r, "cells")) for r in rows), default=0) if m is None else m
    data = [[""] * max(m, 0) for _ in range(n)]
    for i, row in enumerate(rows, start=1):
        for cell in _list(row, "cells"):
            r, c = i, 1
            if type(cell) is dict:
                r, c = whole(cell.get("row number")) or i, whole(cell.get("column number")) or 1
            if 0 < r <= n and 0 < c <= m:
                data[r - 1][c - 1] = _said(cell)
    return n, m, data


def elements(kids: list) -> tuple[list[tuple], str | None]:
    """(elements, None), or (nothing, the path of the first node that does not fit).

    An element is (kind, ord, path, page_number, x0, y0, x1, y1, text, element_type,
    font, font_size, heading_level, position, image_path, row_count, col_count, data).
    """
    found: list[tuple] = []
    places = dict.fromkeys(LEAVES, 0)
    stack = [iter(enumerate(kids))]
    path: list[int] = [0]
    while stack:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            path.pop()
            continue
        path[-1], node = step
        try:
            if type(node) is not dict:
                raise Misfit
            below = _listed(node, "kids")
            kind = node.get("type")
            kind = kind.lower() if type(kind) is str else ""
            if kind in TEXT_TYPES:
                text = (string(node.get("content")) or "").strip()
                if text:
                    found.append((
                        "text", len(found), tuple(path), count(node, "page number") or 0, *_box(node), text, kind,
                        string(node.get("font")), real(node.get("font size")), whole(node.get("heading level"), 32), None, None, None, None, None,
                    ))
            elif kind in LEAVES:
                place = places[kind]
                places[kind] = place + 1
                page, box, below = count(node, "page number") or 0, _box(node), ()
                if kind == "image":
                    found.append(("image", len(found), tuple(path), page, *box, None, kind, None, None, None, place, string(node.get("path")), None, None, None))
                elif (grid := _grid(node)) is not None:
                    found.append(("table", len(found), tuple(path), page, *box, None, kind, None, None, None, place, None, *grid))
        except Misfit:
            return [], "/".join(map(str, path))
        if below:
            stack.append(iter(enumerate(below)))
            path.append(0)
    return found, None


def document(text: str | None) -> tuple[str | None, int | None, list | None, list[tuple] | None, str | None]:
    """(file_name, page_count, metadata, elements, error), all null for null."""
    if text is None:
        return None, None, None, None, None
    try:
        root = loads(text)
    except (ValueError, RecursionError):
        return None, None, None, None, "not JSON"
    try:
        kids = _listed(root, "kids") if type(root) is dict else None
    except Misfit:
        kids = None
    if kids is None:
        return None, None, None, None, "not an object with a list of kids"
    try:
        counts = count(root, "number of pages"), count(root, "page count")
    except Misfit:
        return None, None, None, None, "a page count is no number"
    found, where = elements(kids)
    if where is not None:
        return None, None, None, None, f"misfit at {where}"
    return string(root.get("file name")) or "", counts[0] or counts[1] or 0, [(k, string(root.get(v))) for k, v in METADATA.items()], found, None
