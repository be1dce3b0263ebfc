"""Mapping patterns are written in the RE2 dialect; Spark matches with Java's."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Joins the captures of one match; lines that hold it take the slower way.
_SEPARATOR = "\x01"

_BLANKS = r"\t\n\f\r "
_EDGE = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"
_NO_EDGE = r"(?:(?<=\w)(?=\w)|(?<!\w)(?!\w))"
_CLASS = re.compile(r"\[:(\^?)([a-z]+):\]")
_GROUP = re.compile(r"\(\?P?<([A-Za-z_][A-Za-z0-9_]*)>")
_FLAGS = re.compile(r"\(\?([a-zA-Z]*)(?:-([a-zA-Z]+))?([:)])")
# POSIX class name -> Java property.
_POSIX = {
    "alnum": "Alnum", "alpha": "Alpha", "ascii": "ASCII", "blank": "Blank",
    "cntrl": "Cntrl", "digit": "Digit", "graph": "Graph", "lower": "Lower",
    "print": "Print", "punct": "Punct", "space": "Space", "upper": "Upper",
    "xdigit": "XDigit",
}


@dataclass(frozen=True)
class JavaPattern:
    text: str
    groups: int                # number of capture groups
    names: dict[str, int]      # group name -> group number


def to_java(pattern: str) -> JavaPattern:
    """Rewrite a pattern so that Java matches what RE2 would.

    Named groups become plain ones (Java allows no ``_`` in names), ``.`` and
    ``$`` know only ``\\n`` as a line end, ``\\s`` and ``\\b`` are ASCII, and
    ``[`` or ``&&`` inside a class are ordinary characters.
    """
    out: list[str] = []
    names: dict[str, int] = {}
    groups = 0
    in_class = False
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            step = pattern[i:i + 2]
            if len(step) < 2:
                raise ValueError(f"invalid regex {pattern!r}: trailing backslash")
            if step == r"\Q":
                end = pattern.find(r"\E", i)
                end = len(pattern) if end < 0 else end
                out.append(re.escape(pattern[i + 2:end]))
                i = end + 2
                continue
            if step[1] in "123456789kGRXhHZ":
                raise ValueError(f"invalid regex {pattern!r}: {step} is not supported")
            out.append(_escape(step, in_class))
            i += 2
        elif in_class:
            posix = _CLASS.match(pattern, i)
            if posix:
                if posix.group(2) not in _POSIX:
                    raise ValueError(f"invalid regex {pattern!r}: unknown {posix.group()}")
                out.append(("\\P{" if posix.group(1) else "\\p{") + _POSIX[posix.group(2)] + "}")
                i = posix.end()
                continue
            in_class = ch != "]"
            out.append("\\" + ch if ch in "[&" else ch)
            i += 1
        elif ch == "[":
            in_class = True
            out.append(ch)
            i += 1
            if pattern[i:i + 1] == "^":
                out.append("^")
                i += 1
            if pattern[i:i + 1] == "]":   # a leading ] is a member
                out.append(r"\]")
                i += 1
        elif ch == "(" and pattern[i + 1:i + 2] == "?":
            named, flags = _GROUP.match(pattern, i), _FLAGS.match(pattern, i)
            if named:
                groups += 1
                if named.group(1) in names:
                    raise ValueError(f"invalid regex {pattern!r}: repeated {named.group(1)!r}")
                names[named.group(1)] = groups
                out.append("(")
                i = named.end()
            elif flags and set(flags.group(1) + (flags.group(2) or "")) <= set("ims"):
                # RE2 folds case over all of Unicode.
                out.append(flags.group().replace("i", "iu"))
                i = flags.end()
            else:
                raise ValueError(f"invalid regex {pattern!r}: {pattern[i:i + 4]!r} is not supported")
        else:
            groups += ch == "("
            if ch in "*+?}" and pattern[i + 1:i + 2] == "+":
                raise ValueError(f"invalid regex {pattern!r}: possessive quantifier")
            out.append(ch)
            i += 1
    if in_class:
        raise ValueError(f"invalid regex {pattern!r}: missing closing ]")
    return JavaPattern("".join(out), groups, names)


def _escape(step: str, in_class: bool) -> str:
    if step == r"\s":
        return _BLANKS if in_class else f"[{_BLANKS}]"
    if step == r"\S":
        return f"[^{_BLANKS}]"
    if step == r"\v":
        return r"\x0B"
    if not in_class and step in (r"\b", r"\B"):
        return _EDGE if step == r"\b" else _NO_EDGE
    return step


def joined_captures(line: Column, pattern: JavaPattern) -> Column:
    """All captures of the first match as one text that starts with the separator.

    One pass over the line gets every group: the match, and the text around it,
    is replaced by the captures. Without a match the line itself comes back.
    """
    whole = rf"(?d)\A(?s:.*?)(?:{pattern.text})(?s:.*)\z"
    groups = _SEPARATOR.join(f"${n}" for n in range(1, pattern.groups + 1))
    return F.regexp_replace(line, whole, _SEPARATOR + groups)


def captures(line: Column, joined: Column, pattern: JavaPattern) -> Column:
    """Array of the captures; NULL if the line does not match.

    ``joined`` is ``joined_captures`` of the line, as a column of its own so
    that it is worked out once. An optional group that took no part gives ''.
    """
    body = f"(?d)(?:{pattern.text})"
    groups = [F.regexp_extract(line, body, n) for n in range(1, pattern.groups + 1)]
    one_by_one = F.when(line.rlike(body), F.array(*groups) if groups else F.array(F.lit("")))
    return F.when(F.contains(line, F.lit(_SEPARATOR)), one_by_one).when(
        joined.startswith(_SEPARATOR), F.split(F.substr(joined, F.lit(2)), _SEPARATOR, -1)
    )
