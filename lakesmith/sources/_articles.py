"""Identifier lists of an XML text, a piece at a time (helper of the tasks of ``xml``).

A text is cut behind ends of articles.  The XML parser (expat) checks each piece
between the text's head and the end of its root, so pieces that pass make up a
well-formed text; a cut that was none between two records (one in a comment, say)
does not pass, and the piece is joined with the next.

The lists of a checked piece are found by the places of its tags, as arrays.  A
piece that holds anything else than plain tags and text around its lists
(comments, CDATA, other attributes, numeric references) is read by the
parser's events instead, with the same rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.parsers import expat

ARTICLE_END = b"</PubmedArticle>"
# Text parsed at once.
PIECE_BYTES = 1 << 20
LISTS_SCHEMA = "ArticleIds array<array<struct<_IdType: string, _VALUE: string>>>"
# what comes before the first child of the root, if it is nothing special
_HEAD = re.compile(rb"\s*(?:<\?xml[^>]*\?>\s*)?(?:<!DOCTYPE[^\[\]<>]*>\s*)?<([^\s<>/!?\"'=&]+)(?:\s[^<>]*)?(?<!/)>")
_OTHER_ENCODING = re.compile(rb"encoding\s*=\s*[\"'](?!(?i:utf-8)[\"'])")
_REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")]


class DamagedFile(ValueError):
    """A text that cannot be read or is not well-formed."""


def pieces(path: str) -> Iterator[tuple[bytes, bytes, bool]]:
    """``(head, piece, last)`` of a file, decompressed by its ending; the head is empty where the text begins otherwise, which then is one piece."""
    from lakesmith.sources import _fs

    try:
        filesystem, inner = _fs.resolve(path)
        with filesystem.open_input_stream(inner, compression="detect") as f:
            text = f.read(PIECE_BYTES)
            if not text:
                return
            found = _HEAD.match(text)
            head = found[0] if found and found[1] + b">" != ARTICLE_END[2:] and not _OTHER_ENCODING.search(found[0]) else b""
            parts, more = [text[len(head):]], True
            while more:
                at = parts[-1].rfind(ARTICLE_END) if head else -1   # an end that two reads share is one of the next piece's
                if at >= 0:
                    at += len(ARTICLE_END)
                    yield head, b"".join([*parts[:-1], parts[-1][:at]]), False
                    parts = [parts[-1][at:]]
                more = f.read(PIECE_BYTES)
                parts.append(more)
            yield head, b"".join(parts), True
    except (OSError, EOFError) as e:
        raise DamagedFile(f"{path}: {e}") from None


def checked(head: bytes, piece: bytes, last: bool) -> None:
    """``ExpatError`` if the piece is not well-formed between the head and the end of the root; entities of its own are not resolved."""
    parser, entities = expat.ParserCreate(), []
    parser.EntityDeclHandler = lambda name, *_: entities.append(name)
    parser.Parse(head, False)
    parser.Parse(piece, False)
    parser.Parse(b"" if last else b"</" + _HEAD.match(head)[1] + b">", True)
    if any(f"&{x};".encode() in piece for x in entities):
        raise expat.ExpatError("a reference to an entity that the text declares")


def lists_of(head: bytes, piece: bytes, last: bool, own_only: bool):
    """The piece's lists (an Arrow array); ``ExpatError`` if it is not well-formed."""
    checked(head, piece, last)
    found = _by_places(piece, own_only) if head else None
    return found if found is not None else _by_events(head, piece, last, own_only)


def lists_of_file(path: str, own_only: bool) -> Iterator:
    """The lists of a file, an Arrow array for each piece."""
    pending = b""
    for head, piece, last in pieces(path):
        pending += piece
        try:
            found = lists_of(head, pending, last, own_only)
        except expat.ExpatError as e:
            if last:
                raise DamagedFile(f"{path}: {e}") from None
            continue   # the cut was not between two records
        pending = b""
        yield found


def _array(counts, types, values):
    """Arrow lists of ``counts`` ids each; a list without ids is null."""
    import numpy as np
    import pyarrow as pa

    counts = np.asarray(counts, dtype=np.int64)
    ids = pa.StructArray.from_arrays([types, values], ["_IdType", "_VALUE"])
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=np.append(counts == 0, False)), ids)


def _words(padded: bytes):
    """Eight bytes from every place, as a number."""
    import numpy as np

    return np.ndarray(len(padded) - 7, dtype="<u8", buffer=padded, strides=(1,))


def _word(text: bytes) -> int:
    return int.from_bytes(text, "little")


def _slices(text: bytes, starts, ends):
    """The parts of an UTF-8 text between places, as an Arrow array."""
    import numpy as np
    import pyarrow as pa

    edges = np.empty(2 * len(starts) + 1, dtype=np.int32)
    edges[0], edges[1::2], edges[2::2] = 0, starts, ends
    every = pa.StringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges), pa.py_buffer(text))
    return every.take(pa.array(np.arange(1, len(edges) - 1, 2)))


def _by_places(text: bytes, own_only: bool):
    """Lists of a well-formed piece of plain tags and text; None if it holds something else."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if b"\r" in text or b"&" in text and b"&#" in text or len(text) >= 1 << 30:
        return None
    padded = text + bytes(32)
    bytes_, words = np.frombuffer(padded, np.uint8), _words(padded)
    marks = np.flatnonzero(bytes_ | 2 == ord(">"))   # "<" too
    lt, gt = marks[::2], marks[1::2]
    if len(lt) != len(gt) or (bytes_[lt] != ord("<")).any() or (bytes_[gt] != ord(">")).any():
        return None
    first = bytes_[lt + 1]
    if ((first == ord("!")) | (first == ord("?"))).any():
        return None
    closes = first == ord("/")
    name = words[lt + 1]
    mine = np.flatnonzero(name == _word(b"ArticleI"))
    rest = words[lt[mine] + 9]
    is_id = (rest == _word(b"d IdType")) & (words[lt[mine] + 17] & 0xFFFF == _word(b'="'))
    is_list = rest & 0xFFFF_FFFF_FFFF == _word(b"dList>")
    if not (is_id | is_list).all():
        return None
    ids, lists = mine[is_id], mine[is_list]
    ends = np.flatnonzero(name == _word(b"/Article"))
    ends = ends[words[lt[ends] + 9] & 0xFF_FFFF_FFFF_FFFF == _word(b"IdList>")]
    # each list holds ids alone, and they hold text alone
    if len(ends) != len(lists) or (ends < lists).any() or (lists[1:] < ends[:-1]).any():
        return None
    counts = np.searchsorted(ids, ends) - np.searchsorted(ids, lists)
    if (ends - lists - 1 != 2 * counts).any() or counts.sum() != len(ids) or not closes[ids + 1].all() or (bytes_[gt[ids] - 1] != ord('"')).any():
        return None
    if own_only:
        depth = np.cumsum(np.where(closes, -1, np.where(bytes_[gt - 1] == ord("/"), 0, 1)))
        opens = ~closes & (bytes_[gt - 1] != ord("/"))
        articles = np.flatnonzero(name == _word(b"PubmedAr"))
        articles = articles[words[lt[articles] + 9] & 0xFF_FFFF_FFFF == _word(b"ticle")]
        data, own = np.flatnonzero(opens & (depth == 2)), depth[lists] == 3
        if not len(data) or (depth[articles] != 1).any() or (bytes_[lt[articles] + 14] != ord(">")).any():
            return None
        parents = data[np.searchsorted(data, lists[own]) - 1]
        # an article has one list of its own, the first in each
        if (name[parents] != _word(b"PubmedDa")).any() or (words[lt[parents] + 9] & 0xFF_FFFF != _word(b"ta>")).any():
            return None
        if not np.array_equal(np.searchsorted(articles, lists[own]), np.arange(1, len(articles) + 1)):
            return None
        ids = ids[np.repeat(own, counts)]
        counts = counts[own]
    types = _slices(text, lt[ids] + len('<ArticleId IdType="'), gt[ids] - 1)
    if any(re.search("[\"&\t\n]", x) for x in types.unique().to_pylist()):
        return None
    values, begin = _slices(text, gt[ids] + 1, lt[ids + 1]), bytes_[gt[ids] + 1]
    if b"&" in text:
        for reference, character in _REFERENCES:
            values = pc.replace_substring(values, reference, character)
    blank = (begin <= ord(" ")) | (begin == ord("<"))   # values of white space alone are null
    if blank.any():
        blank[blank] = pc.invert(pc.match_substring_regex(values.filter(pa.array(blank)), "[^ \\t\\n]")).to_numpy(zero_copy_only=False)
        values = pc.if_else(pa.array(blank), pa.scalar(None, pa.string()), values)
    return _array(counts, types, values)


def _by_events(head: bytes, piece: bytes, last: bool, own_only: bool):
    """Lists of any well-formed piece.  Of a value's texts the last is taken, as comments and elements part them; of
    an article's lists the last too.  Names below the record count in any case."""
    import pyarrow as pa

    # names from the record down; a record in a record is none
    wanted = ["pubmedarticle", "pubmeddata", "articleidlist", "articleid"][0 if own_only else 2:]
    record = "PubmedArticle" if own_only else "ArticleIdList"
    inside = other = 0   # wanted elements that are open, and elements below them that are not
    rows, found, kind, texts = [], [], None, []

    def start(name, attributes):
        nonlocal inside, other, found, kind
        texts.clear()
        if other or (name != record if not inside else inside == len(wanted) or name.lower() != wanted[inside]):
            other += bool(inside)
            return
        inside += 1
        if inside == len(wanted):
            kind = next((v for k, v in attributes.items() if k.lower() == "idtype"), None)
            found.append((kind, None))
        else:
            found = []

    def end(_):
        nonlocal inside, other
        parted()
        if other:
            other -= 1
        elif inside:
            inside -= 1
            if not inside:
                rows.append(found)

    def parted(*_):
        text = "".join(texts)
        if inside == len(wanted) and not other and text.strip(" \t\r\n"):
            found[-1] = (kind, text)
        texts.clear()

    def child(name, attributes):
        parted()
        start(name, attributes)

    parser = expat.ParserCreate()
    parser.specified_attributes = True   # those that the text has
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = child, end, texts.append
    parser.CommentHandler = parser.ProcessingInstructionHandler = parted
    parser.Parse(head + piece, False)
    parser.Parse(b"" if last else b"</" + _HEAD.match(head)[1] + b">", True)
    flat = [x for r in rows for x in r]
    return _array([len(r) for r in rows], pa.array([k for k, _ in flat], pa.string()), pa.array([v for _, v in flat], pa.string()))
