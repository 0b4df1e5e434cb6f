"""SentencePiece encoding and decoding over a relational lattice.

A text is cut into units only between two characters that no piece holds side
by side, so no piece can cross a cut and the units' best paths together are the
text's best path.  Each distinct unit is segmented once: its substrings up to
the longest piece are exploded and equi-joined to the piece table, and the edges
are grouped by unit and folded into the best path (Viterbi): those of units of up
to ``STEP`` characters many units at a time, as arrays; a long unit's by a Spark
higher-order aggregate, ``STEP`` characters at a time, where each step hands the
nodes that a piece can still start from on to the next one.
Characters without a piece become byte pieces, so decoding gives back every
text exactly.

Documents stay where they are read.  A task asks for the distinct units of its
block of documents; requests and segmented units are joined, and the answers are
written by asking task, in chunks of bounded size, to the shared folder, where
the task that encodes the block reads its own.  So no task needs the whole
vocabulary, frequent words travel once per block, and no text is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.session import fresh_dir

#: characters of a unit that are folded in one step
STEP = 64
#: the mark that stands for a space in pieces, and what stands for the mark itself in units (no piece has it)
SPACE_MARK, LITERAL_MARK = "▁", "\uffff"
#: a score counts as a cost in whole units of this many to one: the fold adds and compares integers
COST_UNITS = 10_000
#: cost of a character without a piece, more than any piece's
UNKNOWN_COST = 100 * COST_UNITS
#: fields of a lattice edge, from its low bits on: piece id, start, end, cost, and the end again, by which edges are sorted
START, END, COST, ORDER = 22, 29, 36, 56
PLACE_MASK = (1 << (END - START)) - 1
#: ids from here on stand for the character whose code point is ``id - OWN``
OWN = 1 << 20
#: bytes of text of a block (one batch of rows at least)
BLOCK_BYTES = 8_000_000
#: low bits of a block's number: which of its task's blocks it is, and a checksum of its units
NUMBER_BITS, MARK_BITS = 18, 24
#: units of a chunk of answers; units whose paths are found together; characters of units that one task segments; bytes of text that are cut at once (one row at least);
#: rows that are decoded at once
CHUNK, TOGETHER, PART_CHARS, SLICE_BYTES, ROWS = 1024, 4096, 500_000, 1_000_000, 1000


@dataclass
class Pieces:
    """Piece table of a model: ``(id, piece, cost)`` rows, and the id of byte piece 0x00."""

    rows: list
    byte_base: int
    surface: list               # bytes of each id; b"" for control pieces

    @property
    def longest(self) -> int:
        return max(len(p) for _, p, _ in self.rows)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "id int, piece string, cost long")

    def cutter(self) -> Cutter:
        return Cutter([p for _, p, _ in self.rows])


class Cutter:
    """Cuts texts between characters that no piece holds side by side."""

    def __init__(self, pieces: list[str]):
        pairs = {pair for p in pieces for pair in zip(p, p[1:])}
        number = {c: i for i, c in enumerate(sorted({c for pair in pairs for c in pair}), 1)}
        self.joined = np.zeros((len(number) + 1, len(number) + 1), bool)
        for x, y in pairs:
            self.joined[number[x], number[y]] = True
        self.number = np.zeros(0x110000, np.uint16)
        for c, i in number.items():
            self.number[ord(c)] = i
        # in texts a space is what the mark is in pieces, and the mark itself is in no piece
        self.number[ord(" ")], self.number[ord(SPACE_MARK)] = number.get(SPACE_MARK, 0), 0

    def units(self, texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
        """Units of texts, one after the other, and how many each text has; every text is given a space in front."""
        spaced = [" " + t if t else "" for t in texts]
        whole = "".join(spaced)
        data = whole.encode()
        at = self.number[np.frombuffer(whole.encode("utf-32-le"), "<u4")]
        ends = np.cumsum([0, *map(len, spaced)])
        starts = np.ones(len(at) + 1, bool)
        starts[1:-1] = ~self.joined[at[:-1], at[1:]]
        starts[ends] = True
        cuts = np.flatnonzero(starts)
        places = np.append(np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80), len(data))      # of characters in bytes
        units = pa.Array.from_buffers(pa.string(), len(cuts) - 1, [None, pa.py_buffer(places[cuts].astype(np.int32)), pa.py_buffer(data)])
        return units, np.diff(np.searchsorted(cuts, ends))



def load_pieces(path: str) -> Pieces:
    """Pieces of a SentencePiece model file with byte fallback.

    Unigram models keep their scores (log probabilities).  The scores of a BPE
    model are merge ranks, not probabilities; they are replaced by those of
    Zipf's law, ``-ln(rank + 2)``.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
    bytes_ = [i for i in range(n) if model.is_byte(i)]
    if len(bytes_) != 256 or bytes_ != list(range(bytes_[0], bytes_[0] + 256)):
        raise ValueError("the model has no byte pieces")
    scores = [model.get_score(i) for i in plain]
    ranks = all(s == int(s) for s in scores)
    logs = [-float(np.log(2 - s)) if ranks else float(s) for s in scores]
    rows = [(i, model.id_to_piece(i), min(max(round(-x * COST_UNITS), 0), UNKNOWN_COST - 1)) for i, x in zip(plain, logs, strict=True)]
    if n > OWN or max(len(p) for _, p, _ in rows) >= STEP:
        raise ValueError("more or longer pieces than an edge can hold")
    surface = [b""] * n
    for i, p, _ in rows:
        surface[i] = p.replace(SPACE_MARK, " ").encode()
    for k, i in enumerate(bytes_):
        surface[i] = bytes([k])
    return Pieces(rows, bytes_[0], surface)


def _keys(unit) -> dict:
    """Hashes of 64 and 32 bits that stand for a unit, however long."""
    return {"key": F.xxhash64(unit), "key2": F.hash(unit)}


def _paths(batches, reach: int, byte_base: int):
    """Best paths of units of one step, all units of a chunk place by place; edges and nodes are those of ``segment``."""
    leads = np.array([0, 0, 0xC0, 0xE0, 0xF0])
    for b in (whole.slice(k, TOGETHER) for whole in batches for k in range(0, whole.num_rows, TOGETHER)):
        n, lists = b.num_rows, b.column("edges")
        edge, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
        unit, end = np.repeat(np.arange(n), sizes), (edge >> ORDER) - reach
        at = np.maximum.reduceat(end, np.cumsum(sizes) - sizes)            # each unit has edges
        order = np.argsort(end, kind="stable")                             # units stay in order within a place
        edge, unit, end = edge[order], unit[order], end[order]
        start = ((edge >> START) & PLACE_MASK) - reach
        nodes = np.zeros((n, at.max() + 1), np.int64)
        bounds = np.searchsorted(end, np.arange(1, nodes.shape[1]))
        for place, (x, y) in enumerate(zip(bounds, [*bounds[1:], len(end)]), 1):
            u = unit[x:y]
            reached = (nodes[u, start[x:y]] & (-1 << COST)) + (edge[x:y] & ((1 << ORDER) - 1))
            first = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
            nodes[u[first], place] = np.minimum.reduceat(reached, first)
        live, met = np.arange(n), []
        while len(live):                                                   # from the last place to the first
            node = nodes[live, at]
            at = ((node >> START) & PLACE_MASK) - reach
            met.append((live, at, node & ((1 << START) - 1)))
            live, at = live[at > 0], at[at > 0]
        owner, place, ids = (np.concatenate(x) for x in zip(*met))
        order = np.lexsort((place, owner))
        owner, ids = owner[order], ids[order]
        # characters without a piece: their UTF-8 bytes as byte pieces
        char = ids - OWN
        sizes = 1 + (char >= 0x80).astype(np.int64) + (char >= 0x800) + (char >= 0x10000)
        which = np.repeat(np.arange(len(ids)), sizes)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        char, ids, sizes = char[which], ids[which], sizes[which]
        bits = char >> 6 * (sizes - 1 - nth)
        ids = np.where(char < 0, ids, byte_base + np.where(nth == 0, bits + leads[sizes], (bits & 63) + 128))
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner[which], minlength=n))])
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("key2"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))], names=["key", "key2", "ids"])


def segment(units: DataFrame, pieces: Pieces, parts: int) -> DataFrame:
    """``(key, key2, ids)`` from distinct ``unit``: the path of the least cost; on ties the later piece is the longer one.

    An edge is one integer (its fields are above); its places count from
    ``longest`` characters before its step.  So is a node of the fold: the edge
    that reaches it, with the cost of the whole path (less what all paths into
    the step share); the smaller integer is the better node.
    """
    reach = pieces.longest
    text = F.col("unit")
    keyed = units.withColumns(_keys(text)).repartition(parts, "key")
    long = keyed.where(F.char_length(text) > STEP).select("key", "key2", F.split(text, rf"(?s)(?<=\G.{{{STEP}}})(?=.)").alias("steps"))
    windows = F.transform("steps", lambda x, i: F.struct(
        F.when(i == 0, F.lit(0)).otherwise(reach - 1).alias("lead"),
        F.when(i == 0, x).otherwise(F.concat(F.substring(F.get("steps", i - 1), -(reach - 1), reach - 1), x)).alias("text")))
    in_steps = long.select("key", "key2", F.posexplode(windows).alias("step", "w")).select("key", "key2", "step", "w.lead", "w.text")
    in_one = keyed.where(F.char_length(text) <= STEP).select("key", "key2", F.lit(0).alias("lead"), text.alias("text"))
    byte_base = pieces.byte_base
    table = F.broadcast(pieces.table(units.sparkSession))       # the model's pieces, a fixed table

    def field(value, place):
        return F.shiftleft(value.cast("long"), place)

    def edges(windows, *by):
        # substrings that end in the step itself
        first = F.greatest(F.lit(1), F.col("lead") + 1 - F.col("s"))
        last = F.least(F.lit(reach), F.col("n") - F.col("s"))
        subs = (
            windows.withColumns({"esc": F.translate("text", SPACE_MARK + " ", LITERAL_MARK + SPACE_MARK), "n": F.char_length("text")})
            .withColumn("s", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
            .withColumn("l", F.explode(F.when(first <= last, F.sequence(first, last))))
            .withColumn("piece", F.expr("substring(esc, s + 1, l)"))
        )
        # a single character without a piece keeps an edge of its own, which connects every lattice
        start = F.col("s") - F.col("lead") + reach
        end = start + F.col("l")
        cost, piece = F.coalesce("cost", F.lit(UNKNOWN_COST)), F.coalesce("id", F.ascii(F.expr("substring(text, s + 1, 1)")) + OWN)
        edge = field(end, ORDER) + field(cost, COST) + field(end, END) + field(start, START) + piece
        return subs.join(table, "piece", "left").where("id is not null or l = 1").groupBy(*by).agg(F.collect_list(edge).alias("edges"))

    short = edges(in_one, "key", "key2").mapInArrow(lambda it: _paths(it, reach, byte_base), "key long, key2 int, ids array<int>")
    whole = edges(in_steps, "key", "key2", "step").groupBy("key", "key2").agg(
        F.sort_array(F.collect_list(F.struct("step", F.sort_array("edges").alias("edges")))).alias("steps"))

    def start_of(x):
        return F.shiftright(x, START).bitwiseAND(F.lit(PLACE_MASK)).cast("int")

    def grow(nodes, edge, before):
        # ``before``: places in front of the first node
        node = F.get(nodes, start_of(edge) - before).bitwiseAND(F.lit(-1 << COST)) + edge.bitwiseAND(F.lit((1 << ORDER) - 1))
        # edges come by their end: the first one of an end adds its node
        return F.when(F.size(nodes) + before == F.shiftright(edge, ORDER), F.concat(nodes, F.array(node))).otherwise(
            F.concat(F.slice(nodes, F.lit(1), F.size(nodes) - 1), F.array(F.least(F.element_at(nodes, -1), node))))

    def fold(done, step):
        # a step starts from the last nodes of the one before, whose least cost becomes 0
        handed = F.slice(F.element_at(done, -1), -(reach + 1), reach + 1)
        least = F.array_min(handed).bitwiseAND(F.lit(-1 << COST))
        nodes = F.when(step["step"] == 0, F.array(F.lit(0).cast("long"))).otherwise(F.transform(handed, lambda x: x - least))
        before = F.when(step["step"] == 0, F.lit(reach)).otherwise(F.lit(0))
        return F.concat(done, F.array(F.aggregate(step["edges"], nodes, lambda held, edge: grow(held, edge, before))))

    def back(path, node):
        # nodes from the last to the first; the head of the path is the place that the next one must end at
        here = F.shiftright(node, END).bitwiseAND(F.lit(PLACE_MASK)) == F.get(path, F.lit(0))
        return F.when(here, F.concat(F.array(start_of(node), node.bitwiseAND(F.lit((1 << START) - 1)).cast("int")), F.slice(path, F.lit(2), F.size(path)))).otherwise(path)

    def back_steps(paths, nodes):
        # steps from the last to the first; a place of a step lies ``STEP`` higher in the one before
        head = F.array(F.get(F.get(paths, F.lit(0)), F.lit(0)) + STEP)
        return F.concat(F.array(F.aggregate(F.reverse(nodes), head, back)), paths)

    def as_bytes(i):
        # the character's UTF-8 bytes as byte pieces
        c = i - OWN

        def tail(shift):
            return F.shiftright(c, shift).bitwiseAND(F.lit(63)) + 128 + pieces.byte_base

        def lead(shift, mark):
            return F.shiftright(c, shift) + mark + pieces.byte_base

        return (
            F.when(i < OWN, F.array(i)).when(c < 0x80, F.array(lead(0, 0))).when(c < 0x800, F.array(lead(6, 0xC0), tail(0)))
            .when(c < 0x10000, F.array(lead(12, 0xE0), tail(6), tail(0))).otherwise(F.array(lead(18, 0xF0), tail(12), tail(6), tail(0)))
        )

    none = F.expr("array(array(0L))")
    folded = whole.select("key", "key2", F.aggregate("steps", F.slice(none, 1, 0), fold).alias("steps"))
    # without the nodes that were handed on
    own = folded.select("key", "key2", F.transform("steps", lambda x, i: F.slice(x, F.when(i == 0, F.lit(2)).otherwise(reach + 2), F.size(x))).alias("steps"))
    goal = F.array(F.array(F.size(F.element_at("steps", -1)) + (reach - STEP)))
    paths = own.select("key", "key2", F.aggregate(F.reverse("steps"), goal, back_steps, lambda p: F.flatten(
        F.transform(F.slice(p, F.lit(1), F.size(p) - 1), lambda x: F.slice(x, F.lit(2), F.size(x))))).alias("ids"))
    long_paths = paths.select("key", "key2", F.when(F.array_max("ids") < OWN, F.col("ids")).otherwise(F.flatten(F.transform("ids", as_bytes))).alias("ids"))
    return short.unionByName(long_paths)


def _blocks(batches) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Blocks of a task's rows, numbered alike whenever the same rows are read in the same order."""
    from pyspark import TaskContext

    number, held, size = TaskContext.get().partitionId() << NUMBER_BITS, [], 0
    for b in batches:
        held.append(b)
        size += b.column("text").nbytes
        if size >= BLOCK_BYTES:
            yield number, held
            number, held, size = number + 1, [], 0
    if held:
        yield number, held


def _slices(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``SLICE_BYTES`` of text."""
    for b in held:
        size = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False)
        ends = np.flatnonzero(np.diff(np.cumsum(size, dtype=np.int64) // SLICE_BYTES)) + 1
        edges = [0, *ends.tolist(), b.num_rows]
        for x, y in zip(edges, edges[1:]):
            if y > x:
                yield b.slice(x, y - x)


def _vocabulary(number: int, held: list[pa.RecordBatch], cutter: Cutter) -> tuple[int, pa.Array]:
    """The block's distinct units as first met; before them its number with a checksum of them, so that another block's answers never fit."""
    units = pa.concat_arrays([pa.array([], pa.string())] + [cutter.units(b.column("text").to_pylist())[0].unique() for b in _slices(held)]).unique()
    mark = 0
    for k in range(0, len(units), CHUNK):
        mark = zlib.crc32("\0".join(units[k:k + CHUNK].to_pylist()).encode(), mark)
    task, number = divmod(number, 1 << NUMBER_BITS)
    return task << (NUMBER_BITS + MARK_BITS) | (mark >> (32 - MARK_BITS)) << NUMBER_BITS | number, units


def _ask(batches, cutter: Cutter):
    for number, held in _blocks(batches):
        block, units = _vocabulary(number, held, cutter)
        for k in range(0, len(units), CHUNK):
            some = units[k:k + CHUNK]
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([k], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some)], names=["block", "first", "units"])
        del held, units
        pa.default_memory_pool().release_unused()


def _answers(folder: str, block: int) -> tuple[np.ndarray, np.ndarray]:
    """What was answered to a block: ids of its units one after the other, and their numbers."""
    import pyarrow.dataset as ds
    import pyarrow.parquet as pq

    from lakesmith.sources import _fs

    here, flat, sizes = _fs.join(folder, f"task={block >> (NUMBER_BITS + MARK_BITS)}"), [], []
    for name in sorted(_fs.list_files(here)):
        if name.endswith(".parquet"):
            with _fs.open_input(_fs.join(here, name)) as f:
                t = pq.read_table(f, columns=["block", "chunk", "ids"], filters=ds.field("block") == block, use_threads=False).sort_by("chunk")
            for ids in t.column("ids"):
                flat.append(ids.values.flatten().to_numpy())
                sizes.append(ids.values.value_lengths().to_numpy())
    return np.concatenate([*flat, np.zeros(0, np.int32)]), np.concatenate([*sizes, np.zeros(0, np.int32)])


def _encode(batches, folder: str, cutter: Cutter):
    for number, held in _blocks(batches):
        block, units = _vocabulary(number, held, cutter)
        flat, lengths = _answers(folder, block) if len(units) else (np.zeros(0, np.int32),) * 2
        if len(lengths) != len(units):
            raise RuntimeError("the rows are not read in the order in which their units were collected; encode a table read from files, or pass stage=True")
        starts = np.cumsum(lengths, dtype=np.int64) - lengths
        met = at = n = to = values = lists = None
        for b in _slices(held):
            met, n_units = cutter.units(b.column("text").to_pylist())
            at = pc.index_in(met, value_set=units).to_numpy()
            n = lengths[at]
            to = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
            values = flat[np.repeat(starts[at] - to[:-1], n) + np.arange(to[-1])]
            ends = to[np.concatenate([[0], np.cumsum(n_units)])].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()), mask=b.column("text").is_null())
            yield pa.RecordBatch.from_arrays([b.column("row"), lists], names=["row", "ids"])
        del units, flat, lengths, starts, met, at, n, to, values, lists
        pa.default_memory_pool().release_unused()


def encode(docs: DataFrame, pieces: Pieces, *, text_col: str = "text", keep: list[str] | None = None, stage: bool = False) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all but the text) as struct ``row``, and ``ids``, the text's piece ids.

    A null text has null ids, an empty one none.  Repeated rows are encoded
    row by row; an empty table gives an empty result.  Ties in score go to the
    path whose last differing piece is longer.  Columns travel in the struct,
    so any names are fine.

    ``docs`` is read twice and must give the same rows in the same order, as a
    table read from files does; ``stage=True`` writes other frames to such a
    table first.  Should the order differ, the job fails; it never encodes by
    another block's answers.
    """
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    spark = docs.sparkSession
    path = fresh_dir(spark, "piece_encoding")
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    rows = docs.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    if stage:
        rows.write.parquet(f"{path}/rows")
        rows = spark.read.parquet(f"{path}/rows")
    cutter = pieces.cutter()
    rows.mapInArrow(lambda it: _ask(it, cutter), "block long, first int, units array<string>").write.option("compression", "zstd").parquet(f"{path}/asked")
    asked = spark.read.parquet(f"{path}/asked")
    asked.select(F.explode("units").alias("unit")).distinct().write.parquet(f"{path}/units")
    units = spark.read.parquet(f"{path}/units")
    chars = units.agg(F.sum(F.char_length("unit"))).first()[0] or 0
    segment(units, pieces, chars // PART_CHARS + 1).write.parquet(f"{path}/known")
    tasks = asked.agg(F.max(F.shiftright("block", NUMBER_BITS + MARK_BITS))).first()[0] or 0
    wanted = asked.select("block", "first", F.posexplode("units").alias("place", "unit")).select(
        "block", (F.col("first") + F.col("place")).alias("place"), *[k.alias(name) for name, k in _keys(F.col("unit")).items()])
    answers = (
        wanted.join(spark.read.parquet(f"{path}/known"), ["key", "key2"])
        .select(F.shiftright("block", NUMBER_BITS + MARK_BITS).cast("int").alias("task"), "block", "place", "ids").repartition(tasks + 1, "task")     # small parts: each is sorted in memory
        .groupBy("task", "block", F.floor(F.col("place") / CHUNK).alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("place", "ids"))).alias("all"))
    )
    answers.select("task", "block", "chunk", F.col("all.ids").alias("ids")).write.partitionBy("task").option("compression", "zstd").parquet(f"{path}/answers")
    out = StructType([rows.schema["row"], StructField("ids", ArrayType(IntegerType()))])
    return rows.mapInArrow(lambda it: _encode(it, f"{path}/answers", cutter), out)


def decode(encoded: DataFrame, pieces: Pieces, *, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all but the ids) as struct ``row``, and ``text``; inverse of ``encode``.

    ``keep`` may name the ids too, which then travel once and come back as they are.
    Ids of control pieces and ids that the model lacks add nothing; bytes that
    are not UTF-8 become U+FFFD (``encode`` makes neither); null ids give null.
    """
    from pyspark.sql.types import StringType, StructField, StructType

    spark = encoded.sparkSession
    keep = [c for c in encoded.columns if c != ids_col] if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    within = keep.index(ids_col) if ids_col in keep else None
    rows = encoded.select(row) if within is not None else encoded.select(row, F.col(f"`{ids_col}`").alias("ids"))
    sent = spark.sparkContext.broadcast(pieces.surface)         # the model's pieces, a fixed table

    def spell(batches):
        surface = sent.value
        n = len(surface)
        for b in (whole.slice(k, ROWS) for whole in batches for k in range(0, whole.num_rows, ROWS)):
            texts = []
            for ids in b.column(1) if within is None else b.column(0).field(within):
                if not ids.is_valid:
                    texts.append(None)
                    continue
                s = b"".join([surface[i] for i in ids.values.to_numpy(zero_copy_only=False).tolist() if i is not None and 0 <= i < n]).decode("utf-8", "replace")
                texts.append(s[1:] if s.startswith(" ") else s)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["row", "text"])
            del texts
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(spell, StructType([rows.schema["row"], StructField("text", StringType())]))
