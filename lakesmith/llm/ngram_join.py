"""N-gram Jaccard join: rare-first prefix filter with length, positional and suffix filters.

Documents become sets of hashed word shingles; equal sets form one class, and
only classes are joined.  Shingles are ordered rare-first by a count sketch of
fixed size (any total order keeps the prefix filter exact; ties go by hash).
Two sets at the threshold share a shingle in their prefixes, so the prefixes
are shuffled by shingle, and a shingle of one class is dropped there.

The answer asks for connected classes, so not every pair is needed:

1. within a shingle the classes are chained in order of size; chain pairs that
   pass the filters are verified once per pair on the whole sets;
2. the links found so far give components; where a shingle's classes are in
   several, they are chained again in random orders, which joins most of what
   belongs together at the cost of few pairs;
3. then every remaining pair, of classes in different components, that shares
   a prefix shingle and passes the filters is verified.  This step makes the
   result exact, and a large group of near copies, joined by its chains, adds
   few pairs to it.  Copies that are too far from all others stay alone in such
   a group and meet all of it; the parities of the two sets, which bound by how
   many shingles they differ, are compared in the join, so only pairs close to
   the threshold leave it.

A shingle that is frequent within a map piece is chained there and only its
first class is sent on; its other rows are dealt at random.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesmith.llm._graph import connected_components
from lakesmith.llm._words import NO_ID, SPACE, U, mix, pieces, scan, utf8, whole_groups, windows
from lakesmith.session import fresh_dir

WORDS = 5
PERCENT = 80
#: buckets of the count sketch that orders shingles (8 bytes each; sent to every task)
SKETCH = 1 << 20
SKETCH_PARTS = 64
#: ranges of the shingle hash that the suffix filter compares, one byte each
RANGES = 256
#: words of 64 bits that hold a set's parities, which the last step compares: a bit tells whether the set has an odd number of the shingles dealt to it
PARITY_WORDS = 8
#: classes with one shingle in a map piece from which on they are chained there
HOT = 16
#: bytes of text of a map piece, and of texts that are cut at once (one row at least): cutting takes some 50 bytes a byte
PIECE_BYTES, SCAN_BYTES = 4_000_000, 1_000_000
#: neighbours that a class meets in each of the random orders of step 2, and about how many rows are ordered together
NEIGHBOURS, TOGETHER = (1, 4), 64
#: bits that say which documents' sets are written for verification
WANTED_BITS = 1 << 24

POSTINGS = "route long, kind tinyint, token long, n int, cls long, pos int, prev_cls long, prev_n int, prev_pos int"
SHARED = "token long, n int, cls long, pos int, prev_cls long, prev_n int, prev_pos int"
PARITIES = [f"p{k}" for k in range(PARITY_WORDS)]
CLASSES = f"id long, cls long, n int, ranges binary, parity struct<{', '.join(f'{p}: long' for p in PARITIES)}>"


def _sets(batches, words: int):
    """(ids, [sorted distinct shingle hashes or None]) per piece."""
    for batch in batches:
        for a, b, _, _ in pieces(batch.column(1), PIECE_BYTES):
            sets = []
            for _, _, off, raw in pieces(batch.column(1).slice(a, b - a), SCAN_BYTES):
                w = scan(off, raw, SPACE, True)
                sets += [np.unique(windows(w.hash[s:e], words)) if e > s else None for s, e in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)]
            yield batch.column(0).slice(a, b - a), sets


def _class(u: np.ndarray) -> int:
    """64-bit digest of a set; like the shingles', equal digests count as equal."""
    return int.from_bytes(hashlib.blake2b(u.tobytes(), digest_size=8).digest(), "little", signed=True)


def _parities(sets: list) -> pa.StructArray:
    """Parities of each set, ``PARITY_WORDS`` integers; sets differ in at least as many shingles as they do in parities."""
    bits = np.zeros((len(sets), 64 * PARITY_WORDS), np.uint8)
    for row, u in zip(bits, sets, strict=True):
        if u is not None:
            row[:] = np.bincount((u % U(64 * PARITY_WORDS)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    packed = np.packbits(bits, axis=1).view(np.int64)
    return pa.StructArray.from_arrays([pa.array(packed[:, k]) for k in range(PARITY_WORDS)], names=PARITIES)


def _classes(batches, words: int):
    """Class and size of each document's set, its counts by range of the shingle hash and its parities."""
    shift = U(64 - (RANGES - 1).bit_length())
    for ids, sets in _sets(batches, words):
        yield pa.RecordBatch.from_arrays([
            ids.cast(pa.int64()), pa.array([None if u is None else _class(u) for u in sets], pa.int64()),
            pa.array([0 if u is None else len(u) for u in sets], pa.int32()),
            pa.array([None if u is None else np.bincount((u >> shift).astype(np.int64), minlength=RANGES).clip(max=255).astype(np.uint8).tobytes() for u in sets], pa.binary()),
            _parities(sets),
        ], names=["id", "cls", "n", "ranges", "parity"])


def _sketch(batches, words: int):
    """Document counts of shingles by bucket, one row per task and part of the sketch."""
    total = np.zeros(SKETCH, np.uint32)
    for _, sets in _sets(batches, words):
        filled = [u for u in sets if u is not None]
        if filled:
            total += np.bincount((np.concatenate(filled) & U(SKETCH - 1)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
    parts = total.reshape(SKETCH_PARTS, -1)
    yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_PARTS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "counts"])


def _add_up(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c.as_py(), np.uint32).astype(np.int64) for c in table.column("counts"))
    return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def rare_first(keyed: DataFrame, words: int) -> np.ndarray:
    """Document count of every sketch bucket, over all documents (fixed size)."""
    parts = keyed.mapInArrow(lambda it: _sketch(it, words), "part int, counts binary").groupBy("part").applyInArrow(_add_up, "part int, counts binary")
    out = np.zeros(SKETCH, np.int64).reshape(SKETCH_PARTS, -1)
    for part, counts in parts.collect():
        out[part] = np.frombuffer(counts, np.int64)
    return out.ravel()


def _postings(batches, words: int, percent: int, counts: np.ndarray):
    """Prefix shingles of each class of a piece, rare ones first."""
    for _, sets in _sets(batches, words):
        tokens, sizes, owner, names = [], [], [], []
        for u in sets:
            if u is None:
                continue
            name = _class(u)
            n = len(u)
            prefix = n - (percent * n + 99) // 100 + 1
            freq = counts[(u & U(SKETCH - 1)).astype(np.int64)]
            tokens.append(u[np.argsort(freq, kind="stable")[:prefix]])   # ties by hash: u is sorted
            sizes.append(n)
            names.append(name)
        if not names:
            continue
        names, keep = np.unique(np.array(names, np.int64), return_index=True)   # copies within the piece once
        tokens, sizes = [tokens[i] for i in keep], np.array(sizes)[keep]
        lengths = np.array([len(t) for t in tokens])
        owner = np.repeat(np.arange(len(names)), lengths)
        pos = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        token = np.concatenate(tokens)
        order = np.lexsort((names[owner], sizes[owner], token))
        token, owner, pos = token[order], owner[order], pos[order]
        start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        size = np.diff(np.append(start, len(token)))
        hot = np.repeat(size > HOT, size)
        lead = np.zeros(len(token), bool)
        lead[start] = True
        chained = hot & ~lead
        kind = np.where(chained, 1, np.where(hot, 2, 0)).astype(np.int8)
        route = np.where(chained, mix(token + owner.astype(U)).view(np.int64), token.view(np.int64))
        back = np.roll(owner, 1)
        yield pa.RecordBatch.from_arrays([
            pa.array(route), pa.array(kind), pa.array(token.view(np.int64)), pa.array(sizes[owner], pa.int32()), pa.array(names[owner]), pa.array(pos, pa.int32()),
            pa.array(names[back], mask=~chained), pa.array(sizes[back], pa.int32(), mask=~chained), pa.array(np.roll(pos, 1), pa.int32(), mask=~chained),
        ], names=[f.split()[0] for f in POSTINGS.split(", ")])


def _shared(batches):
    """Rows of shingles that several classes have, each with the class before it; sorted by (route, n, cls)."""
    cols = [f.split()[0] for f in SHARED.split(", ")]
    chained: list = []

    def to_chain():
        for b in batches:
            kind = b.column("kind").to_numpy()
            if (kind == 1).any():
                chained.append(b.filter(pa.array(kind == 1)).select(cols))
                b = b.filter(pa.array(kind != 1))
            if b.num_rows:
                yield b

    for table in whole_groups(to_chain(), "route", 200_000):
        yield from chained
        chained.clear()
        token, kind = table.column("token").to_numpy(), table.column("kind").to_numpy()
        name = table.column("cls").to_numpy()
        first = np.concatenate([[True], token[1:] != token[:-1]])
        alone = ~np.concatenate([[False], ~first[1:] & (name[1:] == name[:-1])])     # not a copy of the row before
        start = np.flatnonzero(first)
        size = np.add.reduceat(alone.astype(np.int64), start)
        rows = np.diff(np.append(start, len(token)))
        keep = np.repeat((size > 1) | (np.maximum.reduceat(kind, start) == 2), rows) & alone
        table, first = table.filter(pa.array(keep)), first[keep]     # a group's first row is no copy
        if not table.num_rows:
            continue
        before = pa.array(np.arange(len(first)) - 1, mask=first)
        for old, new in (("prev_cls", "cls"), ("prev_n", "n"), ("prev_pos", "pos")):
            table = table.set_column(table.schema.get_field_index(old), old, table.column(new).take(before))
        yield from table.select(cols).to_batches()
    yield from chained


def _needed(n: Column, m: Column, percent: int) -> Column:
    """Smallest intersection of sets of ``n`` and ``m`` shingles that reaches the threshold."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))


def _may_link(n: Column, i: Column, m: Column, j: Column, percent: int) -> Column:
    """Length and positional filter, from the places ``i`` and ``j`` of a common shingle in the rare-first orders."""
    long_enough = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    room = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)
    return long_enough & (room >= _needed(n, m, percent))


def _parities_allow(n: Column, x: Column, m: Column, y: Column, percent: int) -> Column:
    """Parity filter: sets that link differ in no more shingles than these, so in no more parities."""
    apart = reduce(add, [F.bit_count(x[p].bitwiseXOR(y[p])) for p in PARITIES])
    return apart <= n + m - 2 * _needed(n, m, percent)


def _last_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of different components that share a shingle and pass the filters; one of each is not of the shingle's main component."""
    x, y = rows.where("comp <> main").alias("x"), rows.alias("y")
    rest = x.hint("merge").join(
        y, (F.col("x.token") == F.col("y.token")) & (F.col("x.comp") != F.col("y.comp"))
        & _may_link(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"), percent)
        & _parities_allow(F.col("x.n"), F.col("x.parity"), F.col("y.n"), F.col("y.parity"), percent)
    )
    return rest.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"))


def _wanted_texts(batches, words: int, bits: np.ndarray):
    """Class and whole text, compressed (a third of its set's size), of the documents whose bit is set."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        pick = pa.array(np.flatnonzero(bits[_bit(ids)]))
        some = pa.RecordBatch.from_arrays([ids.take(pick), texts.take(pick)], names=["id", "text"])
        names, packed = [], []
        for (_, sets), (a, b, off, raw) in zip(_sets([some], words), pieces(some.column(1), PIECE_BYTES), strict=True):
            data = raw.tobytes()
            for i, u in enumerate(sets):
                if u is not None:
                    names.append(_class(u))
                    packed.append(squeeze(data[off[i]:off[i + 1]]))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(packed, pa.binary())], names=["cls", "packed"])


def _bit(ids: pa.Array) -> np.ndarray:
    return (mix(ids.cast(pa.int64()).to_numpy(zero_copy_only=False).astype(U)) & U(WANTED_BITS - 1)).astype(np.int64)


def _mark(batches):
    """Set bits of a task's document ids (each once per task)."""
    seen = np.zeros(WANTED_BITS, bool)
    for b in batches:
        seen[_bit(b.column(0))] = True
    yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen), pa.int64())], names=["bit"])


def _near_enough(batches, percent: int):
    """Suffix filter: what two sets differ by in all ranges together bounds their intersection (counts end at 255, which differ by less)."""
    for b in batches:
        n = b.column("n_a").to_numpy().astype(np.int64) + b.column("n_b").to_numpy()
        x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, RANGES).astype(np.int16) for c in ("ranges_a", "ranges_b"))
        apart = np.abs(x - y).sum(axis=1, dtype=np.int64)
        yield b.filter(pa.array((n - apart) * (100 + percent) >= 2 * percent * n)).select(["a", "b"])


def _linked(batches, words: int, percent: int):
    """Pairs that reach the threshold, by the whole sets."""
    loose = zstandard.ZstdDecompressor().decompress
    for b in batches:
        sets, keep = {}, []
        for side in "ab":
            names, packed = b.column(side).to_pylist(), b.column(f"packed_{side}")
            new = {n: packed[i].as_py() for i, n in enumerate(names) if n not in sets}
            texts = pa.array([loose(x) for x in new.values()], pa.large_binary())
            for a, e, off, raw in pieces(texts, SCAN_BYTES):
                w = scan(off, raw, SPACE, True)
                for i, n in enumerate(list(new)[a:e]):
                    sets[n] = np.unique(windows(w.hash[w.first[i]:w.first[i + 1]], words))
        for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True):
            x, y = sets[x], sets[y]
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        yield b.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def similar_classes(keyed: DataFrame, classes: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(node, component)`` of the classes that are linked with another; ``classes`` is ``(id, cls, n, ranges, parity)``."""
    spark = keyed.sparkSession
    path = fresh_dir(spark, "ngram_join")
    counts = spark.sparkContext.broadcast(rare_first(keyed, words))          # fixed size
    (
        keyed.mapInArrow(lambda it: _postings(it, words, percent, counts.value), POSTINGS)
        .repartition("route").sortWithinPartitions("route", "n", "cls")
        .mapInArrow(_shared, SHARED).write.parquet(f"{path}/shared")
    )
    shared = spark.read.parquet(f"{path}/shared")

    kinds = classes.where("cls is not null").groupBy("cls").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("ranges").alias("ranges"), F.first("parity").alias("parity"))
    kinds.hint("merge").join(shared.select("cls").distinct(), "cls", "left_semi").write.parquet(f"{path}/kinds")
    kinds = spark.read.parquet(f"{path}/kinds")

    def texts_of(pairs: DataFrame, step: str) -> DataFrame:
        """Whole texts of the classes of ``pairs``, each from one document.

        Which documents those are goes to the tasks as a bit table of fixed
        size; what slips through it is dropped by the join.
        """
        named = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
        kinds.select("cls", "id").hint("merge").join(named, "cls", "left_semi").write.parquet(f"{path}/need{step}")
        need = spark.read.parquet(f"{path}/need{step}")
        marks = need.select("id").mapInArrow(_mark, "bit long").distinct().toArrow().column(0).to_numpy()      # at most WANTED_BITS
        bits = np.zeros(WANTED_BITS, bool)
        bits[marks] = True
        sent = spark.sparkContext.broadcast(np.packbits(bits))
        (
            keyed.mapInArrow(lambda it: _wanted_texts(it, words, np.unpackbits(sent.value).astype(bool)), "cls long, packed binary")
            .hint("merge").join(need.select("cls"), "cls", "left_semi").dropDuplicates(["cls"]).write.parquet(f"{path}/texts{step}")
        )
        return spark.read.parquet(f"{path}/texts{step}")

    def verify(pairs: DataFrame, step: str) -> DataFrame:
        """Suffix filter, then the whole sets, once per pair ``(a, b)``."""
        ranges = kinds.select("cls", "n", "ranges")
        (
            pairs.distinct()
            .join(ranges.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("ranges").alias("ranges_a")).hint("merge"), "a")
            .join(ranges.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("ranges").alias("ranges_b")).hint("merge"), "b")
            .mapInArrow(lambda it: _near_enough(it, percent), "a long, b long").write.parquet(f"{path}/pairs{step}")
        )
        pairs = spark.read.parquet(f"{path}/pairs{step}")
        texts = texts_of(pairs, step)
        (
            pairs
            .join(texts.select(F.col("cls").alias("b"), F.col("packed").alias("packed_b")).hint("merge"), "b")
            .join(texts.select(F.col("cls").alias("a"), F.col("packed").alias("packed_a")).hint("merge"), "a")
            .mapInArrow(lambda it: _linked(it, words, percent), "a long, b long").write.parquet(f"{path}/links{step}")
        )
        return spark.read.parquet(f"{path}/links{step}")

    chain = shared.where("prev_cls is not null").where(_may_link(F.col("n"), F.col("pos"), F.col("prev_n"), F.col("prev_pos"), percent))
    links = verify(chain.select(F.least("cls", "prev_cls").alias("a"), F.greatest("cls", "prev_cls").alias("b")).where("a <> b"), "1")
    found = connected_components(links).withColumnsRenamed({"node": "cls", "component": "comp"})
    (
        shared.select("token", "n", "cls", "pos").hint("merge").join(found, "cls", "left")
        .withColumn("comp", F.coalesce("comp", "cls")).write.parquet(f"{path}/labelled")
    )
    rows = spark.read.parquet(f"{path}/labelled")

    def still_open(rows: DataFrame, step: str) -> DataFrame:
        """Rows of the shingles whose classes are not all in one component, with the largest one there."""
        sizes = rows.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"))
        main = sizes.groupBy("token").agg(
            F.max_by("comp", F.struct("k", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"), F.sum("k").alias("rows")).where("comps > 1")
        main.select("token", "main", "rows").write.parquet(f"{path}/main{step}")
        rows.hint("merge").join(spark.read.parquet(f"{path}/main{step}"), "token").write.parquet(f"{path}/open{step}")
        return spark.read.parquet(f"{path}/open{step}")

    def moved(rows: DataFrame, more: DataFrame, step: str) -> DataFrame:
        """A class that was linked with a larger component takes its name: all with one name are connected."""
        names = rows.select("cls", "comp").distinct()
        names.write.parquet(f"{path}/names{step}")
        names = spark.read.parquet(f"{path}/names{step}")
        sizes = names.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
        sized = names.join(sizes, "comp")
        both = more.unionByName(more.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.join(sized.withColumnRenamed("cls", "b"), "b").groupBy(F.col("a").alias("cls")).agg(F.max(F.struct("size", "comp")).alias("best"))
        better = sized.join(best, "cls").where(F.col("best.size") > F.col("size")).select("cls", F.col("best.comp").alias("new"))
        better.write.parquet(f"{path}/moved{step}")
        (
            rows.hint("merge").join(spark.read.parquet(f"{path}/moved{step}"), "cls", "left")
            .select("token", "n", "cls", "pos", F.coalesce("new", "comp").alias("comp")).write.parquet(f"{path}/rows{step}")
        )
        return spark.read.parquet(f"{path}/rows{step}")

    for turn, neighbours in enumerate(NEIGHBOURS):
        step = f"2_{turn}"
        open_rows = still_open(rows, step)
        at = F.xxhash64("cls", F.lit(turn))
        some = Window.partitionBy("token", F.pmod(at, F.ceil(F.col("rows") / TOGETHER))).orderBy(at)       # about TOGETHER rows, however hot the shingle
        pairs = None
        for k in range(1, neighbours + 1):
            near = open_rows.withColumn("y", F.lag(F.struct("cls", "n", "pos", "comp"), k).over(some))
            near = near.where((F.col("y.comp") != F.col("comp")) & _may_link(F.col("n"), F.col("pos"), F.col("y.n"), F.col("y.pos"), percent))
            near = near.select(F.least("cls", "y.cls").alias("a"), F.greatest("cls", "y.cls").alias("b"))
            pairs = near if pairs is None else pairs.unionByName(near)
        more = verify(pairs, step)
        links = links.unionByName(more)
        rows = moved(open_rows.drop("main", "rows"), more, step)

    open_rows = still_open(rows, "3")
    open_rows.hint("merge").join(kinds.select("cls", "parity").hint("merge"), "cls").write.parquet(f"{path}/last")
    open_rows = spark.read.parquet(f"{path}/last")
    more = verify(_last_pairs(open_rows, percent), "3")
    return connected_components(links.unionByName(more))


def ngram_jaccard_join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per document: id, ``n_shingles``, ``component_id`` (smallest id reachable by links, its own included).

    Texts are lower-cased (A-Z) and cut at white space; a text of fewer than
    ``words`` words is one shingle.  Null and empty texts have no shingle and
    no link.  Ids are integers; a null id ranks above all others, so a
    component is named by it only if no member has an id.  Repeated rows are
    equal documents and linked.  Other columns are not read; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    path = fresh_dir(spark, "ngram_classes")
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    keyed.mapInArrow(lambda it: _classes(it, words), CLASSES).write.parquet(f"{path}/classes")
    classes = spark.read.parquet(f"{path}/classes")
    found = similar_classes(keyed, classes, words, percent).withColumnsRenamed({"node": "cls", "component": "comp"})
    (
        classes.select("id", "cls", "n").hint("merge").join(found, "cls", "left")
        .withColumn("comp", F.coalesce("comp", "cls")).write.parquet(f"{path}/labelled")
    )
    labelled = spark.read.parquet(f"{path}/labelled")
    labelled.where("comp is not null").groupBy("comp").agg(F.min("id").alias("least")).write.parquet(f"{path}/least")
    out = labelled.hint("merge").join(spark.read.parquet(f"{path}/least"), "comp", "left")
    real = lambda c: F.nullif(c, F.lit(NO_ID))
    return out.select(real(F.col("id")).alias(id_col), F.col("n").cast("long").alias("n_shingles"), real(F.coalesce("least", "id")).alias("component_id"))
