"""The grammar of trace texts, as two regular expressions shared by Spark and Python.

A new event begins at a line with the mask; nothing inside an event (not even quotes) matters
for that, so any byte range can be split on its own.  A property is the name up to the next
``=`` and a value: in single quotes (a doubled quote is one; a lone one closes only before a comma or the
end), in double quotes (a doubled quote is one; the first lone one closes), or up to the next comma.
Unclosed quotes end with the event; a rest without ``=`` is dropped.
"""

from __future__ import annotations

import re

import numpy as np

MASK = r"[0-9]{2}:[0-9]{2}\.[0-9]{6}-[0-9]+,"
#: Possessive loops: one pass, no backtracking; the same text is valid in Java and Python.
PROPERTY = r"""([^=]*+)=(?:'((?:[^']++|''|'(?!,|\z))*+)(?:'|\z)|"((?:[^"]++|"")*+)(?:"|\z)|([^,]*+)),?+"""
HEADER = r"(?s)\A([^,]*?)-([^,]*),([^,]*),([^,]*)(?:,(.*))?\z"
NUMBER = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"

#: MASK by places: fixed marks, digits, and its least length.
_MARKS, _DIGITS, _LEAST = ((2, 58), (5, 46), (12, 45)), (0, 1, 3, 4, 6, 7, 8, 9, 10, 11, 13), 15
_START = re.compile(rb"^" + MASK.encode(), re.M)
_PROPERTY = re.compile(PROPERTY.replace(r"\z", r"\Z"))
_HEADER = re.compile(HEADER.replace(r"\z", r"\Z"))
_NUMBER = re.compile(NUMBER)
#: Short escapes of JSON; other control characters are \u00xx.
_ESCAPES = {'"': '\\"', "\\": "\\\\", "\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t"}
_TO_ESCAPE = re.compile(r'["\\\x00-\x1f]')


def is_event_start(data: bytes) -> bool:
    return _START.match(data) is not None


def event_starts(data: bytes, begin: int = 0, end: int | None = None) -> list[int]:
    """Places of the events; a mask counts at the start of a line only.  Vectorised: lines are few, so only their starts are tested."""
    end = len(data) if end is None else end
    buf = np.frombuffer(data, np.uint8, end)
    at = np.flatnonzero(buf[begin:] == 10) + begin + 1
    if begin < end and (begin == 0 or buf[begin - 1] == 10):
        at = np.concatenate([[begin], at])
    at = at[at + _LEAST <= end]
    for k, mark in _MARKS:
        at = at[buf[at + k] == mark]
    for k in _DIGITS:
        at = at[buf[at + k] - np.uint8(48) < 10]
    place = at + _LEAST - 1  # the duration has one digit or more before the comma
    good, live = np.zeros(len(at), bool), np.arange(len(at))
    while len(live):
        byte = buf[place[live]]
        good[live[byte == 44]] = True
        live = live[byte - np.uint8(48) < 10]
        place[live] += 1
        live = live[place[live] < end]
    return at[good].tolist()


def split_events(data: bytes) -> list[tuple[int, int]]:
    """(start, end) of each event of a whole file; what stands before the first is dropped."""
    at = event_starts(data.removeprefix(b"\xef\xbb\xbf"))
    at = [k + 3 for k in at] if data.startswith(b"\xef\xbb\xbf") else at
    return list(zip(at, [*at[1:], len(data)], strict=False))


def properties(text: str) -> list[tuple[str, str, bool]]:
    """(name, value, quoted), duplicates kept, in order."""
    out, at = [], 0
    while at < len(text) and (m := _PROPERTY.match(text, at)):
        name, single, double, plain = m.groups()
        if single is not None:
            out.append((name, single.replace("''", "'"), True))
        elif double is not None:
            out.append((name, double.replace('""', '"'), True))
        else:
            out.append((name, plain, False))
        at = m.end()
    return out


def parse_event(text: str) -> tuple[str, str, str, str, list[tuple[str, str, bool]]] | None:
    """(time, duration, event, level, properties), or None if the header is no header."""
    m = _HEADER.match(text.rstrip("\r\n"))
    if not m:
        return None
    time, duration, event, level, rest = m.groups()
    return time, duration.lstrip("0") or ("0" if duration else ""), event, level, properties(rest or "")


def is_number(text: str) -> bool:
    return len(text) <= 32 and _NUMBER.fullmatch(text) is not None


def date_prefix(filename: str) -> str:
    d = filename[:8]
    return f"20{d[:2]}-{d[2:4]}-{d[4:6]}T{d[6:8]}:" if len(d) == 8 and d.isascii() and d.isdigit() else ""


def relative_path(path: str, separator: str = "\\") -> str:
    parts = [p for p in re.split(r"[/\\]", path) if p != "."]
    return separator.join((["", "", *parts])[-3:])


def json_text(text: str) -> str:
    return '"' + _TO_ESCAPE.sub(lambda m: _ESCAPES.get(m[0]) or f"\\u{ord(m[0]):04x}", text) + '"'


def to_ndjson(timestamp: str, duration: str, event: str, level: str, filename: str, file_path: str, props, always_text=("SearchString", "Guid", "UUID")) -> str:
    """One record: the fixed fields, then all properties with duplicates."""
    parts = [f'"timestamp":{json_text(timestamp)}', f'"duration":{duration or 0}', f'"event":{json_text(event)}', f'"level":{level if is_number(level) else json_text(level)}',
             f'"filename":{json_text(filename)}', f'"file_path":{json_text(file_path)}']
    for name, value, quoted in props:
        plain = not quoted and name not in always_text and is_number(value)
        parts.append(f"{json_text(name)}:{value if plain else json_text(value)}")
    return "{" + ",".join(parts) + "}"


def from_ndjson(line: str):
    """(fixed fields, properties): the strict reverse; the six fields must come first, duplicates are kept."""
    import json

    pairs = json.loads(line.removeprefix("﻿"), object_pairs_hook=lambda x: x, parse_int=_Number, parse_float=_Number)
    names = ("timestamp", "duration", "event", "level", "filename", "file_path")
    if not isinstance(pairs, list) or tuple(k for k, _ in pairs[:6]) != names:
        raise ValueError("the record does not begin with the fixed fields")
    if not all(isinstance(v, str) for _, v in pairs):
        raise ValueError("a value is neither text nor number")
    return dict((k, str(v)) for k, v in pairs[:6]), [(k, str(v), not isinstance(v, _Number)) for k, v in pairs[6:]]


class _Number(str):
    """A number's text, kept as it was written."""
