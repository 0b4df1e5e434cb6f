"""Benchmark decontamination: FM-index per training shard, searched with the test phrases.

Each task indexes its documents shard by shard (at most ``_fm.LIMIT`` words and
text ends, so memory is bounded) and searches every test window backwards
through the wavelet-tree ranks.  Occurrences are located by the sampled suffix
positions, compared word by word with the window, and merged into removal
spans.  The test windows are built by tasks into blocks in the shared folder; a
task searches all of them in turn, so a document's row is made in one place and
nothing is shuffled.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.llm._fm import LIMIT, FMIndex
from lakesmith.llm._words import PUNCT, U, pieces, scan, utf8
from lakesmith.session import fresh_dir

WINDOW = 10
#: words of test items searched in one pass over the documents
BLOCK_WORDS = 2_000_000
#: bytes of text of a shard: a word takes two at least, so this is within LIMIT
SHARD_BYTES = 1_000_000
#: bytes of rows that a task holds to search them for one block after another
GROUP_BYTES = 32_000_000


class Phrases:
    """Distinct test windows of a block of items, as word hashes right-aligned in a matrix."""

    def __init__(self, window: int):
        self.window, self.items, self.seen, self.words = window, [], {}, 0

    def add(self, item, text: str | None) -> None:
        """An item of fewer words than the window, but not none, is one window."""
        hashes = scan(*utf8(pa.array([text], pa.string())), PUNCT, True).hash
        self.words += len(hashes)
        size = min(self.window, len(hashes))
        for i in range(len(hashes) - size + 1 if size else 0):
            self.seen.setdefault(hashes[i:i + size].tobytes(), {})[len(self.items)] = None
        self.items.append(item)

    def close(self) -> Phrases:
        rows = [np.frombuffer(k, U) for k in self.seen]
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.hashes = np.zeros((len(rows), self.window), U)
        for i, r in enumerate(rows):
            self.hashes[i, self.window - len(r):] = r
        owners = [list(v) for v in self.seen.values()]
        self.first = np.concatenate([[0], np.cumsum([len(o) for o in owners])]).astype(np.int64)
        self.owner = np.array([x for o in owners for x in o], np.int64)
        self.seen = None
        return self


def _build(batches, window: int, block_words: int, schema: pa.Schema):
    """One row per block of a task's test items; items without words, which match nothing, are in none."""
    squeeze = zstandard.ZstdCompressor(level=3).compress

    def row(block: Phrases) -> pa.RecordBatch:
        block.close()
        packed = squeeze(pickle.dumps((block.lengths, block.hashes, block.first, block.owner)))
        return pa.RecordBatch.from_arrays([pa.array([packed], pa.binary()), pa.array([block.items], schema.field("items").type)], schema=schema)

    block = Phrases(window)
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            before = block.words
            block.add(item, text)
            if block.words == before:
                block.items.pop()
            if block.words >= block_words:
                yield row(block)
                block = Phrases(window)
    if block.items:
        yield row(block)


class Blocks:
    """The blocks written to a folder; small ones are searched together."""

    def __init__(self, folder: str, window: int, block_words: int):
        self.folder, self.window, self.block_words = folder, window, block_words
        self.only, self.many = None, None

    def __iter__(self) -> Iterator[Phrases]:
        """At least one (maybe empty) block; one alone stays in memory."""
        if self.only is not None:
            yield self.only
            return
        held, size, n = [], 0, 0
        for part in self._read():
            if held and size + len(part[0]) > self.block_words:
                self.many = True
                yield self._joined(held)
                held, size, n = [], 0, n + 1
            held.append(part)
            size += len(part[0])
        block = self._joined(held)
        if n == 0:
            self.only, self.many = block, False
        yield block

    def single(self) -> bool:
        """Whether all blocks are searched together."""
        if self.many is None:
            next(iter(self))
        return not self.many

    def _read(self):
        import pyarrow.parquet as pq

        from lakesmith.sources import _fs

        loose = zstandard.ZstdDecompressor().decompress
        for name in sorted(_fs.list_files(self.folder)):
            if name.endswith(".parquet"):
                with _fs.open_input(_fs.join(self.folder, name)) as f:
                    for batch in pq.ParquetFile(f).iter_batches(batch_size=1):
                        for packed, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                            yield (*pickle.loads(loose(packed)), items)

    def _joined(self, parts: list) -> Phrases:
        p = Phrases(self.window)
        p.seen = None
        p.lengths = np.concatenate([np.zeros(0, np.int64), *[x[0] for x in parts]])
        p.hashes = np.concatenate([np.zeros((0, self.window), U), *[x[1] for x in parts]])
        p.first = np.concatenate([[0], *[x[2][1:] + n for x, n in zip(parts, np.cumsum([0, *[x[2][-1] for x in parts]]), strict=False)]]).astype(np.int64)
        p.owner = np.concatenate([np.zeros(0, np.int64), *[x[3] + n for x, n in zip(parts, np.cumsum([0, *[len(x[4]) for x in parts]]), strict=False)]]).astype(np.int64)
        p.items = [i for x in parts for i in x[4]]
        return p


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ranges ``starts[k] .. starts[k] + counts[k] - 1``."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


def occurrences(hashes: np.ndarray, first: np.ndarray, p: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(word position, phrase) of every occurrence within one of the texts."""
    if not len(hashes) or not len(p.lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    fm = FMIndex(hashes, first)
    symbols = fm.symbols(p.hashes.ravel()).reshape(p.hashes.shape)
    lo, hi = fm.search(symbols, p.lengths)
    phrase = np.repeat(np.arange(len(lo)), hi - lo)
    at = fm.locate(_runs(lo, hi - lo))
    at -= np.searchsorted(fm.begin, at, "right") - 1          # without the text ends before it
    right = np.ones(len(at), bool)                            # all 64 bits of every word
    for j in range(p.window):
        k = p.lengths[phrase] - p.window + j
        used = k >= 0
        right[used] &= hashes[at[used] + k[used]] == p.hashes[phrase[used], j]
    return at[right], phrase[right]


def _shard(off, raw, p: Phrases):
    """Words, hit flags and (text, item) pairs of one shard's texts."""
    words = scan(off, raw, PUNCT, True)
    first, n = words.first, len(words.hash)
    if n + len(first) - 1 <= LIMIT:
        at, phrase = occurrences(words.hash, first, p)
    else:                                                     # one very long text: overlapping parts
        parts, size = [], LIMIT - 1
        for a in range(0, n, size - p.window + 1):
            part = words.hash[a:a + size]
            at, phrase = occurrences(part, np.array([0, len(part)]), p)
            parts.append((at + a, phrase))
        at, phrase = (np.concatenate(x) for x in zip(*parts, strict=True))
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + p.lengths[phrase], -1)
    hit = np.cumsum(step[:-1]) > 0
    text = np.searchsorted(first, at, "right") - 1
    counts = np.diff(p.first)[phrase]
    pairs = np.stack([np.repeat(text, counts), p.owner[_runs(p.first[phrase], counts)]], axis=1)
    return words, hit, np.unique(pairs, axis=0) if len(pairs) else pairs


def _groups(batches, blocks: Blocks) -> Iterator[list[pa.RecordBatch]]:
    """Batches that are searched for one block after another; one by one if there is one block."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GROUP_BYTES or blocks.single():
            yield held
            held, size = [], 0
    if held:
        yield held


def _search(batches, blocks: Blocks, schema: pa.Schema, with_text: bool):
    for group in _groups(batches, blocks):
        if blocks.single():
            for batch in group:
                for a, b, off, raw in pieces(batch.column(1), SHARD_BYTES):
                    words, hit, pairs = _shard(off, raw, blocks.only)
                    yield _rows(batch, a, b, off, raw, words, hit, pairs[:, 0], [blocks.only.items[i] for i in pairs[:, 1]], schema, with_text)
            continue
        shards = [(batch, *x) for batch in group for x in pieces(batch.column(1), SHARD_BYTES)]
        hits, texts, items = [None] * len(shards), [[] for _ in shards], [[] for _ in shards]
        for p in blocks:
            for k, (_, _, _, off, raw) in enumerate(shards):
                _, hit, pairs = _shard(off, raw, p)
                hits[k] = hit if hits[k] is None else hits[k] | hit
                texts[k] += pairs[:, 0].tolist()
                items[k] += [p.items[i] for i in pairs[:, 1]]
        for (batch, a, b, off, raw), hit, text, item in zip(shards, hits, texts, items, strict=True):
            order = np.argsort(np.array(text, np.int64), kind="stable")
            yield _rows(batch, a, b, off, raw, scan(off, raw, PUNCT, True), hit, np.array(text, np.int64)[order], [item[i] for i in order], schema, with_text)


def _rows(batch, a, b, off, raw, words, hit, text, items, schema: pa.Schema, with_text: bool) -> pa.RecordBatch:
    """One row per text ``a:b``; ``text`` and ``items``: the matched pairs, in order of the texts."""
    first, k = words.first, b - a
    total = np.concatenate([[0], np.cumsum(hit)])
    edge = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
    cut = first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(hit))]   # a run ends with its text
    cut = np.unique(cut[hit[cut] & hit[cut - 1]]) if len(cut) else cut
    begin = np.sort(np.concatenate([np.flatnonzero(edge == 1), cut]))
    end = np.sort(np.concatenate([np.flatnonzero(edge == -1), cut]))
    of = np.searchsorted(first, begin, "right") - 1
    per = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=k))]).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(begin - first[of], pa.int64()), pa.array(end - first[of], pa.int64())], ["begin", "end"])
    owned = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=k))]).astype(np.int32)
    found = pa.array(items, schema.field("items").type.value_type)
    out = [batch.column(0).slice(a, k), pa.array(np.diff(first), pa.int64()), pa.array(np.diff(total[first]), pa.int64()),
           pa.ListArray.from_arrays(per, spans), pa.ListArray.from_arrays(owned, found)]
    if with_text:
        kept, data = [], raw.tobytes()
        for t in range(k):
            at, left = int(off[t]), []
            for s in range(per[t], per[t + 1]):
                left.append(data[at:words.start[begin[s]]])
                at = int(words.end[end[s] - 1])
            kept.append(b"".join([*left, data[at:off[t + 1]]]).decode())
        out.append(pa.array(kept, pa.string()))
    out += [x.slice(a, k) for x in batch.columns[2:]]
    return pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(out, schema, strict=True)], schema=schema)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
    block_words: int = BLOCK_WORDS, with_text: bool = False, carry: bool = False,
) -> DataFrame:
    """Per document: id, ``n_words``, ``n_hit``, ``spans`` (merged hit word ranges, end excluded), ``items``.

    ``with_text`` adds ``text_kept``, the text without the bytes of the hit
    spans, and ``carry`` adds ``row``, a struct of the document's columns.
    The result does not depend on the number of blocks.  Null and empty texts have no
    words and no hits; null or empty items match nothing; an item id that is
    repeated counts once; repeated documents are judged row by row; empty
    tables give an empty result, or no hits.  Other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    item_type = benchmark.schema[item_id].dataType
    fields = [
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(item_type)),
    ] + ([T.StructField("text_kept", T.StringType())] if with_text else [])
    cols = [F.col(id_col), F.col(text_col).cast("string")]
    if carry:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        fields.append(docs.select(cols[-1]).schema["row"])
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)
    path = f"{fresh_dir(docs.sparkSession, 'decontaminate')}/blocks"
    built = T.StructType([T.StructField("packed", T.BinaryType()), T.StructField("items", T.ArrayType(item_type))])
    built_arrow = to_arrow_schema(built)
    benchmark.select(F.col(item_id), F.col(item_text).cast("string")).mapInArrow(lambda it: _build(it, window, block_words, built_arrow), built).write.parquet(path)
    found = docs.select(*cols).mapInArrow(lambda it: _search(it, Blocks(path, window, block_words), arrow, with_text), schema)
    return found.withColumn("items", F.array_distinct("items"))
