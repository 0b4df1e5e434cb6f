"""Substring dedup: compressed FM-index per shard, matching statistics of streamed documents.

Shards are made by content, so every document meets only the shards that can
hold its passages: a window of 13 words is sent to the shard of its minimizer
(the smallest hash among its 3-word grams), and neighbouring windows with the
same minimizer travel as one segment.  Steps:

1. minimizers only are shuffled; a window whose minimizer no other document
   has cannot repeat, and its text never moves;
2. the remaining segments are shuffled by minimizer, and each task indexes its
   distinct segments (wavelet-tree FM-index, bounded in size) and streams the
   same segments through it by backward search, bounded at the window length;
   the smallest document of each suffix interval decides;
3. spans go back to their documents, which lose the covered words.

A passage that is common within a map task is sent once for its group, and its
other occurrences are dealt at random and joined with that group's result, so
no task holds all occurrences of a hot passage.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesmith.llm._fm import LIMIT, FMIndex
from lakesmith.llm._words import NO_ID, PLACE, SPACE, U, mix, pieces, scan, utf8, whole_groups, windows
from lakesmith.session import fresh_dir

WINDOW = 13
GRAM = 3
#: windows of one segment at most (a longer run of one minimizer is cut; its parts stay in one shard)
SEGMENT = 4096
#: equal segments in one map piece from which on they are sent as one
HOT = 16
PIECE_BYTES = 4_000_000
#: words gathered before a shard is indexed
SHARD_WORDS = 500_000

MINIMIZERS = "route long, kind tinyint, id long, tkey long, begin int, count int"
SURVIVORS = "id long, tkey long, begin int, count int"
SEGMENTS = "route long, kind tinyint, seg long, id long, tkey long, begin int, text string"
FOUND = "kind tinyint, seg long, id long, tkey long, begin int, end int, mins array<long>"


def _batch(spec: str, **cols) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "tinyint": pa.int8(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in spec.split(", ")]
    arrays = [cols[n] if isinstance(cols[n], pa.Array) else pa.array(cols[n], kinds[t]) for n, t in fields]
    return pa.RecordBatch.from_arrays([a.cast(kinds[t]) for a, (_, t) in zip(arrays, fields, strict=True)], names=[n for n, _ in fields])


def minimizers(hashes: np.ndarray, k: int) -> np.ndarray:
    """Smallest gram hash of each run of ``k`` words (runs over text ends included; the caller skips them)."""
    m = min(GRAM, k)
    if len(hashes) < k:
        return np.zeros(0, U)
    low, width, size = windows(hashes, m), k - m + 1, 1
    while size * 2 <= width:
        low, size = np.minimum(low[:-size], low[size:]), size * 2
    return np.minimum(low[:len(low) - (width - size)], low[width - size:]) if width > size else low


def minimizer_runs(hashes: np.ndarray, first: np.ndarray, k: int):
    """Per run of windows that share a minimizer: text, first word, number of windows, minimizer."""
    low = minimizers(hashes, k)
    if not len(low):
        none = np.zeros(0, np.int64)
        return none, none, none, low
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = text[:len(low)] == text[k - 1:]
    start = whole.copy()
    start[1:] &= ~whole[:-1] | (low[1:] != low[:-1])
    at = np.flatnonzero(start)
    so_far = np.concatenate([[0], np.cumsum(whole)])
    count = np.diff(so_far[np.append(at, len(low))])
    parts = (count + SEGMENT - 1) // SEGMENT
    if len(at) and parts.max() > 1:
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at, count = np.repeat(at, parts) + nth * SEGMENT, np.repeat(count, parts) - nth * SEGMENT
        count = np.minimum(count, SEGMENT)
    return text[at], at, count, low[at]


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort order by ``keys`` (the first is the main one) and where each group of the first key(s) but the last starts."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for key in keys[:-1]:
            s = key[order]
            new[1:] |= s[1:] != s[:-1]
    return order, np.flatnonzero(new)


def _spread(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a.astype(U) * PLACE[0] + b.astype(U) * PLACE[1]).view(np.int64)


def _send_minimizers(batches, k: int):
    """Kind 0: a minimizer of one document of the piece; 2: a marker for one that several have; 1: their rows, already known to matter."""
    for batch in batches:
        ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for a, _, off, raw in pieces(batch.column(2), PIECE_BYTES):
            words = scan(off, raw, SPACE, False)
            text, at, count, low = minimizer_runs(words.hash, words.first, k)
            low, begin, own = low.view(np.int64), at - words.first[text], ids[a + text]
            order, start = _groups(low, own)
            if not len(order):
                continue
            s = own[order]
            last = np.append(start[1:], len(order)) - 1
            many = s[start] != s[last]
            shared = np.zeros(len(order), bool)
            shared[order] = np.repeat(many, np.diff(np.append(start, len(order))))
            marker = order[start[many]]
            yield _batch(
                MINIMIZERS,
                route=np.concatenate([np.where(shared, _spread(own, begin), low), low[marker]]),
                kind=np.concatenate([shared.astype(np.int8), np.full(len(marker), 2, np.int8)]),
                id=np.concatenate([own, own[marker]]), tkey=np.concatenate([keys[a + text], keys[a + text[marker]]]),
                begin=np.concatenate([begin, begin[marker]]), count=np.concatenate([count, count[marker]]),
            )


def _surviving(batches):
    """Rows whose minimizer more than one document has."""
    def waiting():
        for b in batches:
            kind = b.column("kind").to_numpy()
            if (kind == 1).any():
                known = b.filter(pa.array(kind == 1))
                direct.append(known.select(["id", "tkey", "begin", "count"]))
                b = b.filter(pa.array(kind != 1))
            if b.num_rows:
                yield b

    direct: list = []
    for table in whole_groups(waiting(), "route", 200_000):
        route, kind, own = (table.column(c).to_numpy() for c in ("route", "kind", "id"))
        start = np.flatnonzero(np.concatenate([[True], route[1:] != route[:-1]]))
        keep = (np.minimum.reduceat(own, start) != np.maximum.reduceat(own, start)) | (np.maximum.reduceat(kind, start) == 2)
        keep = np.repeat(keep, np.diff(np.append(start, len(route)))) & (kind == 0)
        yield from table.filter(pa.array(keep)).select(["id", "tkey", "begin", "count"]).to_batches()
        while direct:
            yield direct.pop()
    yield from direct


def _pack(batches):
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for b in batches:
        texts = [squeeze(t.as_buffer()) if t.is_valid else None for t in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.binary())], names=["id", "tkey", "packed"])


def _unpack(column) -> pa.Array:
    loose = zstandard.ZstdDecompressor().decompress
    return pa.array([loose(t.as_py()) if t.is_valid else None for t in column], pa.large_binary()).cast(pa.large_string())


def _send_segments(batches, k: int):
    """Kind 0: a segment with its text; 2: one that stands for a hot group; 1: the group's other occurrences, without text."""
    for batch in batches:
        ids, keys, runs = batch.column("id").to_numpy(), batch.column("tkey").to_numpy(), batch.column("runs")
        for a, b, off, raw in pieces(_unpack(batch.column("packed")), PIECE_BYTES):
            words = scan(off, raw, SPACE, False)
            part = runs.slice(a, b - a)
            text = np.repeat(np.arange(b - a), part.value_lengths().to_numpy())
            flat = part.flatten()
            begin, count = flat.field("begin").to_numpy().astype(np.int64), flat.field("count").to_numpy().astype(np.int64)
            at = begin + words.first[text]
            low = minimizers(words.hash, k)[at].view(np.int64)
            seg = _segment_hash(words.hash, at, count + k - 1)
            own, key = ids[a + text], keys[a + text]
            order, start = _groups(low, seg, own)
            size = np.diff(np.append(start, len(order)))
            kind, rep = np.zeros(len(order), np.int8), np.zeros(len(order), bool)
            kind[order] = np.repeat(size > HOT, size)
            rep[order[start]] = True
            kind[rep & (kind == 1)] = 2
            s, e = words.start[at], words.end[at + count + k - 2]
            data = raw.tobytes()
            yield _batch(
                SEGMENTS, route=np.where(kind == 1, _spread(own, begin), low), kind=kind, seg=np.where(kind > 0, seg, 0), id=own, tkey=key, begin=begin,
                text=pa.array([data[x:y] if t != 1 else b"" for x, y, t in zip(s.tolist(), e.tolist(), kind.tolist(), strict=True)], pa.binary()).cast(pa.string()),
            )


def _segment_hash(hashes, at, size):
    """Hash of the ``size`` words from ``at`` on: prefix sums of the words' hashes by place."""
    up = np.cumprod(np.concatenate([[U(1)], np.full(len(hashes), PLACE[7], U)]))
    down = np.cumprod(np.concatenate([[U(1)], np.full(len(hashes), U(pow(int(PLACE[7]), -1, 1 << 64)), U)]))
    total = np.concatenate([[U(0)], np.cumsum(hashes * up[:-1])])
    return mix((total[at + size] - total[at]) * down[at] + size.astype(U)).view(np.int64)


def _smallest(hashes, first, low, k):
    """Per window of every segment, the smallest id of a segment that has it.

    ``low[s]`` is the smallest id of segment ``s``.  The segments are indexed
    in shards of at most ``LIMIT`` symbols and streamed through each of them.
    """
    lengths = np.diff(first)
    count = lengths - k + 1
    at = np.repeat(first[:-1], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    best = np.repeat(low, count)
    cost = np.cumsum(lengths + 1)
    a = 0
    while a < len(lengths):
        b = int(np.searchsorted(cost, (cost[a - 1] if a else 0) + LIMIT, "right"))
        fm = FMIndex(hashes[first[a]:first[b]], first[a:b + 1] - first[a], locate=False)
        symbols = fm.symbols(hashes)
        whole = b - a == len(lengths)                           # then every window finds itself
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), fm.n, np.int64)
        live = np.arange(len(at))
        for j in range(k - 1, -1, -1):
            c = symbols[at[live] + j]
            live, c = live[c > 0], c[c > 0]
            if not len(live):
                break
            lo[live], hi[live] = fm.step(c, lo[live], hi[live])
            live = live[hi[live] - lo[live] >= (2 if whole else 1)]
        if len(live):
            row_id = low[a + np.searchsorted(fm.begin, fm.sa, "right") - 1]
            begin, which = np.unique(lo[live], return_inverse=True)
            end = np.zeros(len(begin), np.int64)
            end[which] = hi[live]
            bounds = np.stack([begin, end], axis=1).ravel()
            least = np.minimum.reduceat(np.append(row_id, NO_ID), bounds)[::2]
            best[live] = np.minimum(best[live], least[which])
        a = b
    return best, count


def _match(batches, k: int):
    """Spans of occurrences (kind 0), occurrences of hot segments (1), and what the hot segments' windows found (2)."""
    def local():
        for b in batches:
            kind = b.column("kind").to_numpy()
            if (kind == 1).any():
                h = b.filter(pa.array(kind == 1))
                n = h.num_rows
                passed.append(_batch(FOUND, kind=h.column("kind"), seg=h.column("seg"), id=h.column("id"), tkey=h.column("tkey"), begin=h.column("begin"), end=h.column("begin"), mins=pa.nulls(n, pa.list_(pa.int64()))))
                b = b.filter(pa.array(kind != 1))
            if b.num_rows:
                yield b

    passed: list = []
    for table in whole_groups(local(), "route", 6 * SHARD_WORDS, lambda b: b.column("text").nbytes):
        yield from passed
        passed.clear()
        route, own = table.column("route").to_numpy(), table.column("id").to_numpy()
        start = np.flatnonzero(np.concatenate([[True], route[1:] != route[:-1]]))
        keep = np.minimum.reduceat(own, start) != np.maximum.reduceat(own, start)
        keep = np.repeat(keep, np.diff(np.append(start, len(route)))) | (table.column("kind").to_numpy() == 2)
        table = table.filter(pa.array(keep)).combine_chunks()
        if not table.num_rows:
            continue
        route, own, kind, key, begin = (table.column(c).to_numpy() for c in ("route", "id", "kind", "tkey", "begin"))
        words = scan(*utf8(table.column("text")), SPACE, False)
        seg = _segment_hash(words.hash, words.first[:-1], np.diff(words.first))
        order, at = _groups(route, seg, own)
        rep = order[at]                                         # of equal segments, that of the smallest id
        size = np.diff(np.append(at, len(order)))
        lengths = np.diff(words.first)[rep]
        first = np.concatenate([[0], np.cumsum(lengths)])
        hashes = words.hash[np.repeat(words.first[rep] - first[:-1], lengths) + np.arange(first[-1])]
        best, count = _smallest(hashes, first, own[rep], k)
        base = np.cumsum(count) - count
        of = np.repeat(np.arange(len(rep)), size)               # rows in ``order``: their distinct segment
        per = count[of]
        row = np.repeat(np.arange(len(order)), per)
        nth = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        hit = best[base[of[row]] + nth] < own[order][row]
        edge = hit.copy()
        edge[1:] &= ~(hit[:-1] & (row[1:] == row[:-1]))
        last = hit.copy()
        last[:-1] &= ~(hit[1:] & (row[1:] == row[:-1]))
        s, e = np.flatnonzero(edge), np.flatnonzero(last)
        r = order[row[s]]
        n = len(s)
        yield _batch(FOUND, kind=np.zeros(n, np.int8), seg=np.zeros(n, np.int64), id=own[r], tkey=key[r], begin=begin[r] + nth[s], end=begin[r] + nth[e] + k, mins=pa.nulls(n, pa.list_(pa.int64())))
        hot = np.unique(of[kind[order] == 2])
        if len(hot):
            n = len(hot)
            mins = pa.array([best[base[h]:base[h] + count[h]] for h in hot], pa.list_(pa.int64()))
            yield _batch(FOUND, kind=np.full(n, 2, np.int8), seg=table.column("seg").to_numpy()[[order[at[h]:at[h] + size[h]][kind[order[at[h]:at[h] + size[h]]] == 2][0] for h in hot]], id=own[rep[hot]], tkey=key[rep[hot]], begin=begin[rep[hot]], end=begin[rep[hot]], mins=mins)
    yield from passed


def _keep(batches):
    """Words, removed words and what is left of each text, its words joined by one space."""
    for batch in batches:
        packed, spans = batch.column("packed"), batch.column("spans")
        out = []
        for t, span in zip(_unpack(packed), spans, strict=True):
            off, raw = utf8(pa.array([t.as_py()], pa.large_string()))
            words = scan(off, raw, SPACE, False)
            n = len(words.hash)
            step = np.zeros(n + 1, np.int64)
            if span.is_valid and len(span):
                np.add.at(step, span.values.field("begin").to_numpy(), 1)
                np.add.at(step, span.values.field("end").to_numpy(), -1)
            left = np.cumsum(step[:-1]) <= 0
            data = raw.tobytes()
            kept = b" ".join([data[s:e] for s, e in zip(words.start[left].tolist(), words.end[left].tolist(), strict=True)])
            out.append((n, n - int(left.sum()), kept))
        n, gone, kept = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )


def substring_spans(keyed: DataFrame, window: int = WINDOW) -> DataFrame:
    """Spans ``(id, tkey, begin, end)`` of ``keyed`` (id, tkey, text) that also start in a smaller id; they may overlap."""
    spark = keyed.sparkSession
    path = fresh_dir(spark, "substring_dedup")
    (
        keyed.mapInArrow(lambda it: _send_minimizers(it, window), MINIMIZERS)
        .repartition("route").sortWithinPartitions("route")
        .mapInArrow(_surviving, SURVIVORS)
        .groupBy("id", "tkey").agg(F.sort_array(F.collect_set(F.struct("begin", "count"))).alias("runs"))   # bounded by the document: copies give equal runs
        .write.parquet(f"{path}/survivors")
    )
    packed = keyed.mapInArrow(_pack, "id long, tkey long, packed binary")
    (
        packed.hint("merge").join(spark.read.parquet(f"{path}/survivors"), ["id", "tkey"])
        .mapInArrow(lambda it: _send_segments(it, window), SEGMENTS)
        .repartition("route").sortWithinPartitions("route")
        .mapInArrow(lambda it: _match(it, window), FOUND)
        .write.parquet(f"{path}/found")
    )
    found = spark.read.parquet(f"{path}/found")
    hot = found.where("kind = 2").groupBy("seg").agg(F.min("mins").alias("mins"))
    hit = "(get(mins, i) < id)"
    runs = (   # consecutive windows that go are one span: it is made before anything is exploded
        f"zip_with(filter(sequence(0, size(mins) - 1), i -> {hit} AND NOT coalesce({hit.replace('i)', 'i - 1)')}, false)), "
        f"filter(sequence(0, size(mins) - 1), i -> {hit} AND NOT coalesce({hit.replace('i)', 'i + 1)')}, false)), "
        f"(a, b) -> named_struct('begin', begin + a, 'end', begin + b + {window}))"
    )
    many = (
        found.where("kind = 1").drop("mins").hint("merge").join(hot.where("size(mins) > 0"), "seg")
        .select("id", "tkey", F.explode(F.expr(runs)).alias("s"))
        .select("id", "tkey", "s.begin", "s.end")
    )
    return found.where("kind = 0").select("id", "tkey", "begin", "end").unionByName(many)


def substring_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: id, ``n_words``, ``n_removed``, ``kept_sha256``, ``kept_text``.

    A word goes when a run of ``window`` words that covers it also starts in a
    document with a smaller id (an integer).  Windows are judged on the input.
    Null and empty texts have no words.  A null id ranks above all others, so
    it is a source for nothing.  Rows that repeat an id are judged one by one
    and are no source for each other.  Texts shorter than the window keep all
    words.  Other columns are not read; an empty table gives an empty result.
    """
    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(F.col(text_col)).alias("tkey"), F.col(text_col).cast("string").alias("text"),
    )
    spans = substring_spans(keyed, window).groupBy("id", "tkey").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    packed = keyed.mapInArrow(_pack, "id long, tkey long, packed binary")
    out = packed.hint("merge").join(spans, ["id", "tkey"], "left").mapInArrow(
        _keep, "id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
    return out.withColumn("id", F.nullif(F.col("id"), F.lit(NO_ID))).withColumnRenamed("id", id_col)
