"""Fingerprints of SQL texts: literals become ``?``, their values are kept in order.

One pass of a tokenising regular expression, then small rules on the tokens.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD, _REST = r"A-Za-z_$\u0080-\U0010FFFF", r"A-Za-z0-9_$#@\u0080-\U0010FFFF"
_NUM = r"0[xX][0-9A-Fa-f]+|(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_TOKEN = re.compile(
    rf"""(?P<space>[ \t\r\n]+)
    |(?P<text>[Nn]?'(?:[^']++|'')*+(?:'|\Z))
    |(?P<temp>\#+[{_WORD}]*[{_REST}]*)
    |(?P<rpc>@[Pp][0-9]+(?![{_REST}]))
    |(?P<name>[{_WORD}@][{_REST}]*)
    |(?P<bracket>\[(?:[^\]]++|\]\])*+(?:\]|\Z))
    |(?P<number>{_NUM})
    |(?P<signed>[+-](?:{_NUM}))
    |(?P<any>.)""",
    re.X | re.S,
)
_TAIL = re.compile(r"p_[0-9]+:[ ]?(?:'((?:[^']++|'')*+)(?:'|\Z)[^\n]*|([^\n]*))(?:\n|\Z)")
_BLANK = re.compile(r"[ \t\r]*\n")
_UNARY = frozenset("(,=<>+-*/%")
_HOLE = object()


def _tail(sql: str, at: int) -> tuple[list[str], int] | None:
    """Values of the block of ``p_N:`` lines that begins at a line's start, and where it ends."""
    values = []
    while m := _TAIL.match(sql, at):
        values.append(m[1].replace("''", "'") if m[1] is not None else m[2].rstrip("\r"))
        at = m.end()
        while b := _BLANK.match(sql, at):
            at = b.end()
    return (values, at) if values else None


class _Out:
    """Tokens written so far; lists after IN and VALUES fold as they are written."""

    def __init__(self) -> None:
        self.tokens: list[str] = []
        self.groups: list[dict | None] = []
        self.closed: dict | None = None  # the VALUES group that ended last

    def last(self, skip: int = 0) -> tuple[int, str]:
        i = len(self.tokens) - 1
        while i >= 0:
            if self.tokens[i] != " ":
                if not skip:
                    return i, self.tokens[i]
                skip -= 1
            i -= 1
        return -1, ""

    def hole(self) -> None:
        if self.groups and self.groups[-1]:
            comma, c = self.last()
            before, q = self.last(1)
            if c == "," and q == "?" and before > self.groups[-1]["at"]:
                del self.tokens[before + 1 :]
                return
        self.tokens.append("?")

    def open(self) -> None:
        at, word = self.last()
        group = None
        if len(self.groups) < 64:
            if word.upper() in ("IN", "VALUES"):
                group = {"values": word.upper() == "VALUES", "before": None}
            elif word == "," and self.closed and self.last(1)[0] == self.closed["end"]:
                group = {"values": True, "before": self.closed}
        self.tokens.append("(")
        if group:
            group["at"] = len(self.tokens) - 1
        self.groups.append(group)

    def close(self) -> None:
        group = self.groups.pop() if self.groups else None
        self.tokens.append(")")
        if not (group and group["values"]):
            return
        group["end"] = len(self.tokens) - 1
        group["only"] = [t for t in self.tokens[group["at"] + 1 : group["end"]] if t != " "] == ["?"]
        before = group["before"]
        if before and before["only"] and group["only"]:
            del self.tokens[before["end"] + 1 :]
            self.closed = before
        else:
            self.closed = group


def normalize(sql: str) -> tuple[str, list[str]]:
    """(norm, params)."""
    out, params, tail, at = _Out(), [], [], 0
    while at < len(sql):
        if sql.startswith("p_", at) and (at == 0 or sql[at - 1] == "\n") and (block := _tail(sql, at)):
            tail, at = tail + block[0], block[1]
            continue
        m = _TOKEN.match(sql, at)
        kind, token, end = m.lastgroup, m[0], m.end()
        if kind == "space":
            if out.tokens and out.tokens[-1] != " ":
                out.tokens.append(" ")
        elif kind == "text":
            body = token[token.index("'") + 1 :]
            closed = len(body) - len(body.rstrip("'"))
            params.append((body[:-1] if closed % 2 else body).replace("''", "'"))
            out.hole()
        elif kind == "temp":
            out.tokens.append(re.split("[0-9]", token)[0])
        elif kind == "rpc":
            out.tokens.append(token[:2])
        elif kind == "number":
            params.append(token)
            out.hole()
        elif kind == "signed":
            if out.last()[1][-1:] in _UNARY:  # also true of nothing yet
                params.append(token)
                out.hole()
            else:
                end = at + 1
                out.tokens.append(token[0])
        elif token == "?":
            params.append(_HOLE)
            out.hole()
        elif token == "(":
            out.open()
        elif token == ")":
            out.close()
        else:
            out.tokens.append(token)
        at = end
    values = iter(tail)
    return "".join(out.tokens).strip(" "), [next(values, "?") if p is _HOLE else p for p in params]


#: Texts that a worker has lexed already, up to so many characters; then it begins anew.
_KNOWN_CHARS = 32 << 20
_known: dict[str, tuple[str, list[str]]] = {}
_held = 0


def _fingerprints(texts: pd.Series) -> pd.DataFrame:
    global _held
    rows = []
    for t in texts:
        if t is None:
            rows.append((None, None))
            continue
        found = _known.get(t)
        if found is None:
            if _held > _KNOWN_CHARS:
                _known.clear()
                _held = 0
            found = _known[t] = normalize(t)
            _held += 2 * len(t)
        rows.append(found)
    return pd.DataFrame(rows, columns=["norm", "params"])


def fingerprint(text: Column) -> Column:
    """struct<norm, params> of a text."""
    return F.pandas_udf(_fingerprints, "struct<norm:string,params:array<string>>")(text)
