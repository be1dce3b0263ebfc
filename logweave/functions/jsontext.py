"""Cut JSON text into records without re-writing a byte of them.

A plain helper for Arrow batches: the engine hashes a record's own text, and no
built-in gives back the original slice of a nested array element.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

_SPACE = re.compile(r"[ \t\n\r]*")


# Reads one value of a text from a position: (text, pos) -> (value, end).
Scan = Callable[[str, int], tuple[object, int]]


def _scanner() -> Scan:
    def refuse(constant: str) -> None:
        raise ValueError(f"{constant} is not JSON")

    return json.JSONDecoder(parse_constant=refuse, parse_int=str, parse_float=str).raw_decode


def _skip(text: str, pos: int) -> int:
    return _SPACE.match(text, pos).end()


def _members(text: str, scan: Scan) -> dict[str, str]:
    """Raw text of each member of an object; a repeated key keeps its last."""
    found: dict[str, str] = {}
    pos = _skip(text, 1)
    while text[pos] != "}":
        key, pos = scan(text, pos)
        start = _skip(text, _skip(text, pos) + 1)
        end = scan(text, start)[1]
        found[key] = text[start:end]
        pos = _skip(text, end)
        if text[pos] == ",":
            pos = _skip(text, pos + 1)
    return found


def _elements(text: str, scan: Scan) -> Iterator[str]:
    pos = _skip(text, 1)
    while text[pos] != "]":
        end = scan(text, pos)[1]
        yield text[pos:end]
        pos = _skip(text, end)
        if text[pos] == ",":
            pos = _skip(text, pos + 1)


def _records_of(value: str, record_path: str, scan: Scan) -> Iterator[tuple[str, str | None]]:
    """``(text, error)`` of each record in one complete top-level value."""
    current = value
    if record_path and value.startswith("{"):
        for key in record_path.split("."):
            if current != "null" and not current.startswith("{"):
                yield value, f"record_path {record_path!r}: no object to look up {key!r} in"
                return
            members = {} if current == "null" else _members(current, scan)
            if key not in members:
                yield value, f"record_path {record_path!r}: key {key!r} not found"
                return
            current = members[key]
        if current == "null":
            return
    if current.startswith("["):
        for element in _elements(current, scan):
            yield element, None
    else:
        yield current, None


_STRING = re.compile(r'"(?:[^"\\]|\\.)*+"')


def _change(line: str) -> int:
    """Brackets a line opens less those it closes, outside strings."""
    bare = _STRING.sub("", line)
    return sum(bare.count(c) for c in "[{") - sum(bare.count(c) for c in "]}")


def resumed(text: str) -> Iterator[str]:
    """Units of lines that make no JSON as a whole, as a line among them was cut off.

    A unit begins at a line that opens an object or array and ends where its
    brackets are closed. If no such end comes, or the unit is no JSON, only its
    first line is lost and the next line begins anew.
    """
    lines = text.split("\n")
    depth = [0]
    for line in lines:
        depth.append(depth[-1] + _change(line))
    # ends[i]: where the depth next falls to that before line i, for all i in one pass.
    ends = [0] * len(lines)
    waiting: list[int] = []
    for i in range(len(lines)):
        waiting.append(i)
        while waiting and depth[i + 1] <= depth[waiting[-1]]:
            ends[waiting.pop()] = i + 1
    i = 0
    while i < len(lines):
        unit = lines[i]
        if lines[i].lstrip()[:1] in ("{", "[") and ends[i] > i + 1:
            whole = "\n".join(lines[i : ends[i]])
            if all(not (error or "").startswith("invalid JSON") for _, error in split_records(whole)):
                unit = whole
        i += unit.count("\n") + 1
        yield unit


def split_records(text: str, record_path: str = "") -> Iterator[tuple[str, str | None]]:
    """Records of consecutive top-level values.

    Broken JSON ends the walk: the rest of the text is one row with an error.
    """
    scan = _scanner()
    pos = _skip(text, 0)
    while pos < len(text):
        try:
            end = scan(text, pos)[1]
        except (ValueError, RecursionError) as problem:
            yield text[pos:], f"invalid JSON: {getattr(problem, 'msg', problem)}"
            return
        yield from _records_of(text[pos:end], record_path, scan)
        pos = _skip(text, end)
