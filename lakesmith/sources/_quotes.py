"""Which part of a CSV text a byte range starts in, without reading what lies before it.

A CSV reader is a small automaton, so what a stretch of text does to it is a
function from the state before to the state after.  Functions compose, which is
associative: ranges are examined independently and their functions are composed
afterwards.  There are few such functions (the automaton's transition monoid),
so each has a number, and composing is a table look-up that NumPy does for
millions of bytes at once.
"""

from __future__ import annotations

import re

import numpy as np

#: at the start of a record / of a later field, in an unquoted / a quoted field, behind a quote in one, not well formed
RECORD, FIELD, PLAIN, QUOTED, CLOSED, BAD = range(6)
_QUOTE, _COMMA, _NEWLINE, _OTHER = range(4)
# what each kind of byte does, by state: the strict rules of CSV readers
_STEP = {
    _QUOTE: (QUOTED, QUOTED, PLAIN, CLOSED, QUOTED, BAD),
    _COMMA: (FIELD, FIELD, FIELD, QUOTED, FIELD, BAD),
    _NEWLINE: (RECORD, RECORD, RECORD, QUOTED, RECORD, BAD),
    _OTHER: (PLAIN, PLAIN, PLAIN, QUOTED, BAD, BAD),
}
BLOCK = 1 << 20


def _closure() -> tuple[list[tuple], np.ndarray]:
    """All functions that texts can have (the identity is number 0), and the table of their compositions."""
    found = [tuple(range(6))]
    number = {found[0]: 0}
    for f in found:   # grows while it is read
        for step in _STEP.values():
            g = tuple(step[s] for s in f)
            if g not in number:
                number[g] = len(found)
                found.append(g)
    table = np.array([[number[tuple(g[s] for s in f)] for g in found] for f in found], np.uint16)
    return found, table


FUNCTIONS, _THEN = _closure()
_KIND = np.full(256, _OTHER)
_KIND[ord('"')], _KIND[ord(",")], _KIND[ord("\n")], _KIND[ord("\r")] = _QUOTE, _COMMA, _NEWLINE, _NEWLINE
_OF_BYTE = np.array([FUNCTIONS.index(_STEP[k]) for k in _KIND.tolist()], np.uint16)
_FLAT, _N = _THEN.ravel(), len(FUNCTIONS)


def function_of(data: bytes) -> int:
    """Number of the function of a text, by a tree of compositions."""
    f = _OF_BYTE[np.frombuffer(data, np.uint8)]
    while len(f) > 1:
        if len(f) % 2:
            f = np.append(f, np.uint16(0))
        f = _FLAT[f[0::2].astype(np.uint32) * _N + f[1::2]]
    return int(f[0]) if len(f) else 0


def function_of_range(stream, at: int, end: int) -> int:
    stream.seek(at)
    f = 0
    while at < end:
        data = stream.read(min(BLOCK, end - at))
        if not data:
            break
        at += len(data)
        f = int(_THEN[f, function_of(data)])
    return f


def starts(functions: list[int]) -> list[int]:
    """State before each of the consecutive texts, and behind the last."""
    out = [RECORD]
    for f in functions:
        out.append(FUNCTIONS[f][out[-1]])
    return out


_PLAIN_END = re.compile(rb"[,\r\n]")


def first_record(data: bytes, state: int) -> int | None:
    """Offset behind the first end of a record in ``data`` (0 if a record starts there); None if it has none."""
    at = 0
    while state != RECORD:
        if state == QUOTED:
            at = data.find(b'"', at) + 1
            if not at:
                return None
            state = CLOSED
        elif state == PLAIN:
            m = _PLAIN_END.search(data, at)
            if not m:
                return None
            at, state = m.end(), FIELD if m.group() == b"," else RECORD
        else:
            if at >= len(data):
                return None
            state = _STEP[int(_KIND[data[at]])][state]
            at += 1
            if state == BAD:
                raise ValueError("text behind a closing quote")
    return at
