"""Secret scan through a trigram inverted index.

From each rule's regular expression a Boolean query over three-byte grams is
derived: a text that the rule matches satisfies it.  A task takes its documents
shard by shard, builds the inverted index of the grams that the rules name
(gram -> documents of the shard), evaluates each rule's query by intersecting
and joining postings, and runs the expression on the candidates alone.  A rule
without a mandatory gram scans every text.  Index, postings and texts of a
shard are in one task, so nothing is shuffled and memory is bounded by the
shard; the grams are those of the text with A-Z lower-cased.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: bytes of text of a shard; a longer text is a shard of its own
SHARD_BYTES = 4_000_000
#: strings that a set may hold before it is turned into grams, and characters of a class that are spelled out
MOST, CLASS = 64, 8


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group ``group`` has ``least`` characters or more; ``fold``: ASCII letters in either case."""

    name: str
    pattern: str
    least: int = 0
    group: int = 0
    fold: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | re.IGNORECASE if self.fold else re.ASCII)


# Patterns and least lengths of the base kinds.  A run of 24 or more is what is left of the
# runs [0-9a-f]+ without the shorter ones; stated so, no short run becomes a match.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
#: spans beyond the base kinds: forms that well-known services publish for their credentials
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("url_login", r"://[^/\x20\x09-\x0D:@]{1,64}:[^/\x20\x09-\x0D:@]{1,64}@"),
)

# A query is True (every text), a gram (bytes), or ("and" | "or", frozenset of queries).


def _join(op: str, parts) -> object:
    """``and`` / ``or`` of queries, flattened; True absorbs in ``or`` and drops out of ``and``."""
    flat = set()
    for q in parts:
        if q is True:
            if op == "or":
                return True
            continue
        flat |= q[1] if isinstance(q, tuple) and q[0] == op else {q}
    if not flat:
        return True
    if op == "or":   # a branch that asks for more than another one adds nothing
        asked = {q: q[1] if isinstance(q, tuple) and q[0] == "and" else frozenset([q]) for q in flat}
        flat = {q for q in flat if not any(asked[o] < asked[q] for o in flat)}
    return next(iter(flat)) if len(flat) == 1 else (op, frozenset(flat))


def _grams(strings: set[bytes]) -> object:
    """One of the strings occurs: for one of them, all its grams do."""
    if not strings or min(map(len, strings)) < 3:
        return True
    return _join("or", [_join("and", [s[i:i + 3] for i in range(len(s) - 2)]) for s in strings])


@dataclass
class Part:
    """What is known of the strings that a part of an expression matches.

    ``exact``: all of them, if they are few; else every one starts with one of
    ``head``, ends with one of ``tail`` and satisfies ``query``.
    """

    exact: set[bytes] | None
    head: set[bytes]
    tail: set[bytes]
    query: object

    @classmethod
    def of(cls, exact: set[bytes]) -> Part:
        return cls(exact, exact, exact, True)

    @classmethod
    def any(cls) -> Part:
        return cls(None, {b""}, {b""}, True)

    def loose(self) -> Part:
        """The same without ``exact``: its grams go to the query, its ends are shortened."""
        query = _join("and", [self.query, _grams(self.exact)]) if self.exact is not None else self.query
        return Part(None, _short({s[:3] for s in self.head}, lambda s, n: s[:n]), _short({s[-3:] for s in self.tail}, lambda s, n: s[-n:] if n else b""), query)

    def then(self, other: Part) -> Part:
        if self.exact is not None and other.exact is not None:
            if len(self.exact) * len(other.exact) <= MOST:
                return Part.of({a + b for a in self.exact for b in other.exact})
        seam = {a + b for a in self.tail for b in other.head} if len(self.tail) * len(other.head) <= MOST**2 else {b""}
        query = _join("and", [self.query, other.query, _grams(seam), _grams(self.exact or set()), _grams(other.exact or set())])
        head = {a + b for a in self.exact for b in other.head} if self.exact is not None and len(self.exact) * len(other.head) <= MOST**2 else self.head
        tail = {a + b for a in self.tail for b in other.exact} if other.exact is not None and len(self.tail) * len(other.exact) <= MOST**2 else other.tail
        return Part(None, head, tail, query).loose()

    def either(self, other: Part) -> Part:
        if self.exact is not None and other.exact is not None and len(self.exact | other.exact) <= MOST:
            return Part.of(self.exact | other.exact)
        a, b = self.loose(), other.loose()
        return Part(None, a.head | b.head, a.tail | b.tail, _join("or", [a.query, b.query])).loose()


def _short(strings: set[bytes], cut) -> set[bytes]:
    n = 3
    while len(strings) > MOST and n:
        n -= 1
        strings = {cut(s, n) for s in strings}
    return strings


def _letter(code: int) -> bytes:
    text = chr(code).encode("utf-8", "surrogatepass")
    return text.lower() if code < 128 else text


def _one_of(items) -> Part:
    """A character class, if it is small and lists its characters."""
    out = set()
    for op, value in items:
        if op is C.LITERAL:
            out.add(_letter(value))
        elif op is C.RANGE and value[1] - value[0] < 2 * CLASS:
            out |= {_letter(c) for c in range(value[0], value[1] + 1)}
        else:
            return Part.any()
    return Part.of(out) if len(out) <= CLASS else Part.any()


def _walk(tree) -> Part:
    part = Part.of({b""})
    for op, value in tree:
        part = part.then(_node(op, value))
    return part


def _node(op, value) -> Part:
    if op is C.LITERAL:
        return Part.of({_letter(value)})
    if op is C.IN:
        return _one_of(value)
    if op is C.SUBPATTERN:
        return _walk(value[3]) if not value[1] and not value[2] else Part.any()
    if op is C.ATOMIC_GROUP:
        return _walk(value)
    if op is C.BRANCH:
        first, *rest = [_walk(x) for x in value[1]]
        for x in rest:
            first = first.either(x)
        return first
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        low, high, inner = value
        one, part = _walk(inner), Part.of({b""})
        for _ in range(min(low, 3)):
            part = part.then(one)
        if (low, high) == (0, 1):
            return one.either(part)
        return part if low == high <= 3 else part.then(Part.any())
    if op in (C.AT, C.ASSERT, C.ASSERT_NOT):
        return Part.of({b""})   # takes no character
    return Part.any()


def gram_query(rule: Rule) -> object:
    """The Boolean gram query that every text with a match of the rule satisfies; True where no gram is mandatory."""
    rule.compiled()
    tree = _parser.parse(rule.pattern, re.ASCII)
    if tree.state.flags & (re.IGNORECASE | re.LOCALE | re.VERBOSE):
        raise ValueError(f"rule {rule.name}: state letters in either case by fold, not by a flag in the pattern")
    return _walk(tree).loose().query


def leaves(query: object) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(leaves, query[1]))


class Grams:
    """The grams that some rules name, as a table from three bytes to a place."""

    def __init__(self, queries: list):
        self.grams = sorted(set().union(*map(leaves, queries)))
        self.place = np.zeros(1 << 24, np.uint16 if len(self.grams) < 1 << 16 else np.uint32)
        for n, g in enumerate(self.grams):
            self.place[g[0] << 16 | g[1] << 8 | g[2]] = n + 1


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class Shard:
    """Inverted index of a shard of texts: for each named gram, the documents that hold it, in order."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, grams: Grams):
        self.n, self.grams = len(off) - 1, grams
        b = _FOLD[raw].astype(np.uint32)
        code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) if len(b) > 2 else np.zeros(0, np.uint32)
        place = grams.place[code]
        at = np.flatnonzero(place)
        of = np.searchsorted(off, at, "right") - 1
        whole = at + 3 <= off[of + 1]   # a gram lies in one text
        pair = np.unique(place[at[whole]].astype(np.int64) << 32 | of[whole])
        self.docs = pair & 0xFFFFFFFF
        self.first = np.searchsorted(pair >> 32, np.arange(1, len(grams.grams) + 2))
        self.at = {g: n for n, g in enumerate(grams.grams)}

    def postings(self, gram: bytes) -> np.ndarray:
        n = self.at[gram]
        return self.docs[self.first[n]:self.first[n + 1]]

    def search(self, query: object) -> np.ndarray:
        """Documents that satisfy a query, in order."""
        if query is True:
            return np.arange(self.n)
        if isinstance(query, bytes):
            return self.postings(query)
        found = sorted((self.search(q) for q in query[1]), key=len)
        if query[0] == "or":
            return np.unique(np.concatenate(found))
        out = found[0]   # rarest first
        for x in found[1:]:
            out = np.intersect1d(out, x, assume_unique=True)
        return out


def _shards(batch: pa.RecordBatch):
    """``(first, after, bytes, offsets)`` of a batch's runs of texts."""
    texts = batch.column(1)
    off = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(off, off[a] + SHARD_BYTES, "right")) - 1)
        yield a, b, raw[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def _scan(batches, rules: tuple, queries: list, schema: pa.Schema):
    grams, compiled = Grams(queries), [r.compiled() for r in rules]
    for batch in batches:
        for a, b, raw, off in _shards(batch):
            shard, data = Shard(raw, off, grams), raw.tobytes()
            text: dict[int, str] = {}
            found: list[list] = [[] for _ in range(b - a)]
            for n, (rule, query) in enumerate(zip(rules, queries, strict=True)):
                for i in shard.search(query).tolist():
                    t = text.get(i)
                    if t is None:
                        t = text[i] = data[off[i]:off[i + 1]].decode("utf-8", "replace")
                    for m in compiled[n].finditer(t):
                        x, y = m.span(rule.group)
                        if y - x >= rule.least:
                            found[i].append((m.start(), n, m.end(), m.group(rule.group)))
            rows = [[{"kind": rules[n].name, "start": x, "end": y, "secret": s} for x, n, y, s in sorted(f)] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(rows, schema.field("spans").type), *(c.slice(a, b - a) for c in batch.columns[2:])], schema=schema)


def secret_scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, *, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """Per document: id and ``spans``, an array of ``(kind, start, end, secret)`` by start, then by the rules' order.

    Matches of a rule are the leftmost non-overlapping ones, of which those too
    short are dropped; matches of different rules may overlap.  Offsets count
    code points of the whole match, the end excluded; ``secret`` is the text of
    the rule's group.  Null and empty texts have no spans; bytes that are no
    UTF-8 count as one replacement character each; repeated rows are judged row
    by row; an empty table gives an empty result.  Other columns are not read;
    ``carry`` adds ``row``, a struct of the document's columns.
    """
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("secret", T.StringType())])
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("spans", T.ArrayType(span))]
    cols = [F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")]
    if carry:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        fields.append(docs.select(cols[-1]).schema["row"])
    schema = T.StructType(fields)
    arrow, queries = to_arrow_schema(schema), [gram_query(r) for r in rules]
    return docs.select(*cols).mapInArrow(lambda it: _scan(it, rules, queries, arrow), schema)
