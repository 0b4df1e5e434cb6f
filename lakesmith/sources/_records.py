"""Records of one Latin-1 CSV text, whole: how a file is read is decided before
any row of it is kept (helper of the tasks of ``zipcsv`` and ``plaincsv``).

A first pass parses the text strictly and keeps nothing.  It finds text behind
a closing quote, an unclosed quote (the end of the text is swallowed by a
field) and rows with more fields than the header.  Then the text is read once more in the mode
that fits it:

* ``standard``: the usual rules;
* ``split``: the text does not parse, or its lines are quoted end to end and
  hold unescaped quotes: each line is split on ``","``;
* ``lines``: the text does not parse and is not quoted end to end: each line
  is parsed by itself.

Rows that still do not fit are ragged and stay visible.  In the last two modes
every line is a row.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
import sys
from collections.abc import Callable, Iterator
from itertools import chain

CHUNK_ROWS = 10_000
FALLBACK_SEP = '","'
ENCODING = "latin-1"
STANDARD, SPLIT, LINES = "standard", "split", "lines"
# Names of the engine's own columns; a file's column of that name is numbered.
ARCHIVE, MEMBER, ROW_NO, BAD_LINE, MODE, SOURCE = "_archive", "_member", "_row_no", "_bad_line", "_mode", "source_file"
RESERVED = (ARCHIVE, MEMBER, ROW_NO, BAD_LINE, MODE, SOURCE, "_sig", "_idx", "_fields", "_ragged")
RAW_SCHEMA = (f"{ARCHIVE} string, {MEMBER} string, {ROW_NO} bigint, _fields array<string>, _ragged boolean, "
              f"_sig bigint, {MODE} string")
# ends every text in the first pass; a reader inside a quote swallows it
END = "\x00end of text\x00"

# longest field Python's reader takes: as long as a string can be
csv.field_size_limit(min(sys.maxsize, 2**31 - 1))


def text_of(raw) -> io.TextIOWrapper:
    return io.TextIOWrapper(raw, encoding=ENCODING, newline="")


def split_line(line: str) -> list[str]:
    """Split on ``","``; drop the outer quote of the first and last field."""
    parts = line.rstrip("\r\n").split(FALLBACK_SEP)
    if parts[0].startswith('"'):
        parts[0] = parts[0][1:]
    if parts[-1].endswith('"'):
        parts[-1] = parts[-1][:-1]
    return parts


def clean_header(names: list[str]) -> list[str]:
    """Column names as CSV readers make them unique: blank ones are named by
    their place, repeats are numbered ``a.1``; names that differ only in case,
    or are the engine's own, count as repeats (Spark resolves names without
    regard to case)."""
    out, taken = [], {r.casefold() for r in RESERVED}
    for i, n in enumerate(names):
        base = n if n.strip() else f"Unnamed: {i}"
        name, k = base, 0
        while name.casefold() in taken:
            k += 1
            name = f"{base}.{k}"
        taken.add(name.casefold())
        out.append(name)
    return out


def quoted_line(line: str) -> bool:
    """Quoted from end to end: such lines can be split on the separator between two quotes."""
    line = line.rstrip("\r\n")
    return len(line) > 1 and line.startswith('"') and line.endswith('"')


def decide(stream) -> str:
    """Mode of a text (its first pass)."""
    first = ""
    for first in stream:
        if first.strip("\r\n"):
            break
    else:
        return STANDARD
    quoted = quoted_line(first)
    width, last, ragged = None, None, False
    try:
        for rec in csv.reader(chain([first], stream, [END]), strict=True):
            if rec:
                width = len(rec) if width is None else width
                ragged |= len(rec) > width
                last = rec
    except csv.Error:
        last = None
    if last != [END]:
        return SPLIT if quoted else LINES
    return SPLIT if ragged and quoted else STANDARD


def _alone(line: str) -> list[str] | None:
    """Fields of one line by the standard rules; None if it is no record by itself."""
    line = line.rstrip("\r\n")
    if '"' not in line:
        return line.split(",")
    try:
        recs = list(csv.reader([line, END], strict=True))
    except csv.Error:
        return None
    return recs[0] if len(recs) == 2 and recs[1] == [END] else None


def records(stream, mode: str) -> Iterator[tuple[list[str], bool]]:
    """``(fields, whole)`` of each record; a line that is no record comes whole, as its only field."""
    if mode == STANDARD:
        for rec in csv.reader(stream):
            if rec:   # blank lines are skipped, as CSV readers do by default
                yield rec, True
        return
    for line in stream:
        if line.strip("\r\n"):
            fields = split_line(line) if mode == SPLIT else _alone(line)
            yield (fields, True) if fields is not None else ([line.rstrip("\r\n")], False)


def header(rec: list[str], mode: str) -> tuple[list[str], int]:
    """Column names of a text's first record, and their signature."""
    names = clean_header([h.replace('"', "") for h in rec] if mode == SPLIT else rec)
    return names, int.from_bytes(hashlib.blake2b(json.dumps(names).encode(), digest_size=8).digest(), "little", signed=True)


def batched(rows, archive: str, member: str, mode: str, sig: int | None = None):
    """Arrow record batches (``RAW_SCHEMA``) of ``(number, fields, ragged)``, ``CHUNK_ROWS`` rows at a time;
    row -1 is the header, whose signature all rows carry (``sig``, where the rows have no header)."""
    import pyarrow as pa

    numbers, fields, ragged, size = [], [], [], 0

    def batch():
        n = len(numbers)
        return pa.RecordBatch.from_arrays(
            [pa.array([archive] * n, pa.string()), pa.array([member] * n, pa.string()), pa.array(numbers, pa.int64()),
             pa.array(fields, pa.list_(pa.string())), pa.array(ragged, pa.bool_()), pa.array([sig] * n, pa.int64()),
             pa.array([mode] * n, pa.string())],
            names=[f.split()[0] for f in RAW_SCHEMA.split(", ")])

    for number, rec, odd in rows:
        if number == -1:
            rec, sig = header(rec, mode)
        numbers.append(number)
        fields.append(rec)
        ragged.append(odd)
        size += sum(map(len, rec))
        if len(numbers) >= CHUNK_ROWS or size >= 1 << 25:
            yield batch()
            numbers, fields, ragged, size = [], [], [], 0
    if numbers:
        yield batch()


def chunks(open_raw: Callable, archive: str, member: str, mode: str | None = None):
    """Arrow record batches of one text.

    A row with more fields than the header is ragged; a shorter one is padded
    when read, as CSV readers do.
    """
    if mode is None:
        with open_raw() as raw, text_of(raw) as s:
            mode = decide(s)

    def rows(s):
        width = None
        for number, (rec, whole) in enumerate(records(s, mode), start=-1):
            width = len(rec) if width is None else width
            yield number, rec, not whole or len(rec) > width

    with open_raw() as raw, text_of(raw) as s:
        yield from batched(rows(s), archive, member, mode)
