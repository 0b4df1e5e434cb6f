"""Exact, substring and near-duplicate operators and decontamination against plain Python."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakesmith.llm import decontaminate as dec
from lakesmith.llm import _words, ngram_join, substring_dedup
from lakesmith.llm._fm import FMIndex
from lakesmith.llm._graph import connected_components
from lakesmith.llm._words import PUNCT, SPACE, scan, utf8
from lakesmith.llm.exact_dedup import DigestIndex, exact_dedup, text_digest

from . import brute


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def key(rows):
    return sorted(rows, key=repr)


def random_docs(seed, n=120, words=40):
    """Shared passages, copies and near copies over a small vocabulary."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(10, 30))] for _ in range(6)]
    out = []
    for i in range(n):
        w = [r.choice(vocabulary) for _ in range(r.randint(0, words))]
        if r.random() < 0.5:
            at = r.randint(0, len(w))
            w[at:at] = r.choice(passages)
        if out and r.random() < 0.4:
            w = (out[r.randrange(len(out))][1] or "").split()
            for _ in range(r.randint(0, 2)):
                if w:
                    w[r.randrange(len(w))] = r.choice(vocabulary)
        out.append((i, " ".join(w)))
    r.shuffle(out)
    return out


@pytest.fixture(scope="module")
def random_frame(spark):
    rows = random_docs(5)
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_scan_matches_regex():
    texts = ["  a\x0bb\x0cÉ-x_y9 Z", None, "", "\x00a\x1cb", "tail "]
    for sep, lower, rx in ((SPACE, False, brute.SPACED), (PUNCT, True, brute.LETTERED)):
        off, raw = utf8(pa.array(texts))
        w = scan(off, raw, sep, lower)
        for i, t in enumerate(texts):
            expect = rx.findall((t or "").translate(brute.LOWER) if lower else (t or ""))
            assert w.first[i + 1] - w.first[i] == len(expect)
            for j, x in enumerate(expect):
                assert scan(*utf8(pa.array([x])), sep, lower).hash[0] == w.hash[w.first[i] + j]


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(1)
    lengths = rng.integers(0, 60, 40)
    hashes = rng.choice(rng.integers(0, 2**63, 4).astype(np.uint64), lengths.sum())
    first = np.concatenate([[0], np.cumsum(lengths)])
    fm = FMIndex(hashes, first)
    texts = [hashes[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    for size in (1, 3, 6):
        pats = [t[:size] for t in texts if len(t) >= size]
        lo, hi = fm.search(fm.symbols(np.array(pats, np.uint64).ravel()).reshape(-1, size), np.full(len(pats), size))
        for p, a, b in zip(pats, lo, hi, strict=True):
            expect = sorted(int(fm.begin[i]) + s for i, t in enumerate(texts) for s in range(len(t) - size + 1) if t[s:s + size] == p)
            assert sorted(fm.locate(np.arange(a, b)).tolist()) == expect


def test_exact_dedup_edges(odd_docs, no_docs):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(odd_docs).collect()}
    assert {(1, 3, 4, False), (3, 3, 4, True), (None, 3, 4, False)} <= got
    assert {(4, 5, 2, False), (5, 5, 2, True)} <= got            # null counts as empty
    assert {(8, 9, 2, False), (9, 9, 2, True)} <= got
    assert (12, 12, 2, True) in got
    assert exact_dedup(no_docs).count() == 0


def test_digest_index_persists(spark):
    index = DigestIndex(spark, "digest_index_test", buckets=4)
    index.drop()
    index.create()
    try:
        one = spark.createDataFrame([(1, "a"), (2, "A"), (3, "b")], "doc_id long, text string")
        two = spark.createDataFrame([(4, "B"), (5, "c"), (6, None)], "doc_id long, text string")
        assert {(r.doc_id, r.keep_id, r.kept) for r in index.add(one, batch="one").collect()} == {(1, 2, False), (2, 2, True), (3, 3, True)}
        first = {(r.doc_id, r.keep_id, r.kept) for r in index.add(two, batch="two").collect()}
        assert first == {(4, 3, False), (5, 5, True), (6, 6, True)}
        assert {(r.doc_id, r.keep_id, r.kept) for r in index.add(two, batch="two").collect()} == first      # after a failure
        assert index.rows().count() == 4
        plan = index.unseen(two.select(text_digest(F.col("text")).alias("digest")))._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "LeftAnti" in plan
    finally:
        index.drop()


def test_native_plans_have_no_python(spark, sf_small):
    from lakesmith.llm import queries

    for name in ("op4_url_filter", "op5_exact_dedup"):
        plan = queries.QUERIES[name](spark, sf_small)._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def run_substring(df):
    return key([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(df).collect()])


def test_substring_dedup_random(random_frame):
    rows, df = random_frame
    assert run_substring(df) == key(brute.substring_dedup(rows))


def test_substring_dedup_hot_groups_and_small_shards(random_frame, monkeypatch):
    rows, df = random_frame
    monkeypatch.setattr(substring_dedup, "HOT", 2)              # for what runs on the driver; the tasks take it as sent below
    batches = [b for b in df.toArrow().to_batches()]
    send = list(substring_dedup._send_segments([_with_runs(b) for b in batches], 13))
    kinds = np.concatenate([b.column("kind").to_numpy() for b in send])
    assert {0, 1, 2} <= set(kinds.tolist())
    table = pa.Table.from_batches(send).sort_by("route")
    found = pa.Table.from_batches(list(substring_dedup._match(table.to_batches(), 13))).to_pylist()
    mins = {f["seg"]: f["mins"] for f in found if f["kind"] == 2}
    gone = {}
    for f in found:
        if f["kind"] == 0:
            gone.setdefault(f["id"], set()).update(range(f["begin"], f["end"]))
        elif f["kind"] == 1:
            for i, m in enumerate(mins[f["seg"]]):
                if m < f["id"]:
                    gone.setdefault(f["id"], set()).update(range(f["begin"] + i, f["begin"] + i + 13))
    assert {i: len(gone.get(i, ())) for i, _ in rows} == {r[0]: r[2] for r in brute.substring_dedup(rows)}


def _with_runs(batch):
    """What the second step gets: every run of windows of each document."""
    import zstandard

    runs, packed = [], []
    for t in batch.column("text"):
        off, raw = utf8(pa.array([t.as_py()]))
        w = scan(off, raw, SPACE, False)
        _, at, count, _ = substring_dedup.minimizer_runs(w.hash, w.first, 13)
        runs.append([{"begin": int(a), "count": int(c)} for a, c in zip(at, count, strict=True)])
        packed.append(zstandard.ZstdCompressor().compress((t.as_py() or "").encode()))
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("count", pa.int32())]))
    n = batch.num_rows
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([0] * n, pa.int32()), pa.array(packed, pa.binary()), pa.array(runs, kind)], names=["id", "tkey", "packed", "runs"])


def test_substring_shards_beyond_the_limit(monkeypatch):
    rows = random_docs(9, 60)
    monkeypatch.setattr(substring_dedup, "LIMIT", 200)          # many small indexes in one content shard
    off, raw = utf8(pa.array([t for _, t in rows]))
    w = scan(off, raw, SPACE, False)
    keep = np.flatnonzero(np.diff(w.first) >= 5)
    lengths = np.diff(w.first)[keep]
    hashes = np.concatenate([w.hash[w.first[i]:w.first[i + 1]] for i in keep])
    low = np.array([rows[i][0] for i in keep])
    best, count = substring_dedup._smallest(hashes, np.concatenate([[0], np.cumsum(lengths)]), low, 5)
    texts = [hashes[a:a + n].tolist() for a, n in zip(np.cumsum(lengths) - lengths, lengths, strict=True)]
    least = {}
    for i, t in zip(low, texts, strict=True):
        for a in range(len(t) - 4):
            least[tuple(t[a:a + 5])] = min(least.get(tuple(t[a:a + 5]), i), i)
    assert best.tolist() == [least[tuple(t[a:a + 5])] for t in texts for a in range(len(t) - 4)] and count.sum() == len(best)


def test_substring_dedup_edges(odd_docs, no_docs):
    assert run_substring(odd_docs) == key(brute.substring_dedup(pairs_of(odd_docs)))
    assert run_substring(no_docs) == []


def run_ngram(df):
    return key([tuple(r) for r in ngram_join.ngram_jaccard_join(df).collect()])


@pytest.mark.parametrize("seed", [5, 6])
def test_ngram_join_random(spark, seed):
    rows = random_docs(seed, 90, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert run_ngram(df) == key(brute.ngram_join(rows))


def test_ngram_join_edges(odd_docs, no_docs):
    assert run_ngram(odd_docs) == key(brute.ngram_join(pairs_of(odd_docs)))
    assert run_ngram(no_docs) == []


def test_ngram_join_large_group_of_near_copies(spark):
    """A group is linked through its chains and its hot shingles, and adds no pair of one component."""
    r = random.Random(3)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(150):
        w = list(base)
        w[r.randrange(80)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"u{i}_{j}" for j in range(30))) for i in range(20)]
    got = run_ngram(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    assert {c for i, _, c in got if i < 1000} == {0} and all(c == i for i, _, c in got if i >= 1000)


def test_ngram_sets_cut_little_text_at_once(monkeypatch):
    """The memory of cutting a large batch is that of a small part of it; workers keep what they took once."""
    r = random.Random(8)
    texts = [" ".join(f"w{r.randrange(10_000)}" for _ in range(400)) for _ in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["id", "text"])
    monkeypatch.setattr(_words, "_pow", {"n": 0})
    tracemalloc.start()
    rows = sum(len(sets) for _, sets in ngram_join._sets([batch], 5))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert rows == len(texts) and peak < 100e6, peak


def test_ngram_join_large_group_too_far_apart(spark):
    """Copies of one text that link with none of the others share its shingles, but few of their pairs are looked at."""
    r = random.Random(4)
    base = [r.getrandbits(63) for _ in range(80)]
    sets = [np.array(sorted([*base[:60], *(r.getrandbits(63) for _ in range(20))]), np.uint64) for _ in range(120)]       # 60 of 100 in common
    sets += [np.array(sorted([*sets[k][:72].tolist(), *(r.getrandbits(63) for _ in range(8))]), np.uint64) for k in range(10)]   # 72 of 88
    parity = ngram_join._parities(sets).to_pylist()
    rows = [(7, k, 80, 0, k, 999, p) for k, p in enumerate(parity)]
    schema = "token long, cls long, n int, pos int, comp long, main long, " + ngram_join.CLASSES[ngram_join.CLASSES.index("parity"):]
    got = {(x.a, x.b) for x in ngram_join._last_pairs(spark.createDataFrame(rows, schema), 80).collect()}
    assert {(k, 120 + k) for k in range(10)} <= got and len(got) < 300       # of 8385


@pytest.mark.parametrize("size", [1, 30, 700, 3000])
def test_parities_keep_every_link(spark, size):
    r = random.Random(size)
    sets, links = [], []
    for k in range(40):
        base = [r.getrandbits(63) for _ in range(size)]
        copy = base[:size - r.randrange(size // 5 + 1)] + [r.getrandbits(63) for _ in range(r.randrange(size // 5 + 1))]
        sets += [np.unique(np.array(s, np.uint64)) for s in (base, copy)]
        both = len(set(base) & set(copy))
        links.append(100 * both >= 80 * (len(set(base)) + len(set(copy)) - both))
    parity = ngram_join._parities(sets).to_pylist()
    rows = [(k, k, len(s), 0, k, -1, p) for k, (s, p) in enumerate(zip(sets, parity, strict=True))]
    rows = [(k // 2, *row[1:]) for k, row in enumerate(rows)]       # a text and its copy share a shingle
    schema = "token long, cls long, n int, pos int, comp long, main long, " + ngram_join.CLASSES[ngram_join.CLASSES.index("parity"):]
    got = {x.a // 2 for x in ngram_join._last_pairs(spark.createDataFrame(rows, schema), 80).collect()}
    assert any(links) and {k for k, link in enumerate(links) if link} <= got


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60) if i % 20 != 19], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: i // 20 * 20 for i in range(60)}
    assert connected_components(edges.limit(0)).count() == 0


ITEMS = [(1, "the quick brown fox jumps over the lazy dog and then"), (2, "One two"), (3, ""), (4, None), (2, "one TWO!"),
         (5, "word5 x5 word6 x6 word7 x7 word8 x8 word9 x9 word10 x10"), (6, "never seen words here"), (7, "a b a b a b a b a b a b")]


def run_decontaminate(df, bench, **more):
    return key([(r.doc_id, r.n_words, r.n_hit, sorted(r["items"])) for r in dec.decontaminate(df, bench, **more).collect()])


def test_decontaminate_edges(spark, odd_docs, no_docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    expect = key(brute.decontaminate(pairs_of(odd_docs), ITEMS))
    assert run_decontaminate(odd_docs, bench) == expect
    assert run_decontaminate(no_docs, bench) == []
    assert all(r[2] == 0 and r[3] == [] for r in run_decontaminate(odd_docs, bench.limit(0)))


def test_decontaminate_in_blocks(spark, odd_docs):
    """Searched block by block; repeated rows of one id come out as one row there."""
    docs = odd_docs.dropDuplicates(["doc_id"])
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert run_decontaminate(docs, bench, block_words=5) == run_decontaminate(docs, bench)


def test_decontaminate_blocks_change_nothing(spark, odd_docs):
    """Rows that repeat an id or have none, with the text that is left and the row: one block or many."""
    docs = odd_docs.unionByName(odd_docs.select(F.lit(None).cast("long").alias("doc_id"), *[c for c in odd_docs.columns if c != "doc_id"]))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string").repartition(3)

    def run(**more):
        rows = dec.decontaminate(docs, bench, with_text=True, carry=True, **more).collect()
        return sorted(repr((r.doc_id, r.n_words, r.n_hit, r.spans, sorted(r["items"]), r.text_kept, r.row.text)) for r in rows)

    one = run()
    assert len(one) == docs.count() and run(block_words=5) == run(block_words=1) == one
    assert run_decontaminate(docs, bench, block_words=5) == run_decontaminate(docs, bench) == key(brute.decontaminate(pairs_of(docs), ITEMS))


def test_decontaminate_text(spark):
    docs = spark.createDataFrame([(1, "Keep this, one two. And that"), (2, "none")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    got = {r.doc_id: (r.text_kept, [tuple(s) for s in r.spans], r.row.text) for r in dec.decontaminate(docs, bench, with_text=True, carry=True).collect()}
    assert got == {1: ("Keep this, . And that", [(2, 4)], "Keep this, one two. And that"), 2: ("none", [], "none")}


def test_decontaminate_text_beyond_one_index(monkeypatch):
    monkeypatch.setattr(dec, "LIMIT", 64)
    words = [f"w{i % 50}" for i in range(400)]
    p = dec.Phrases(10)
    p.add(1, " ".join(words[33:48]))
    p.close()
    off, raw = utf8(pa.array([" ".join(words)]))
    _, hit, pairs = dec._shard(off, raw, p)
    assert hit.sum() == brute.decontaminate([(1, " ".join(words))], [(1, " ".join(words[33:48]))])[0][2] and len(pairs) == 1


def test_substring_dedup_of_many_copies(spark):
    """A thousand rows without an id, copies of one another: each loses its words, and the work stays linear in them."""
    from lakesmith.llm import substring_dedup as sd

    text = " ".join(f"w{i}" for i in range(40)) + " end"
    rows = [(1, text)] + [(None, text + " more words here")] * 1000 + [(None, "x " * 5), (7, " ".join(f"w{i}" for i in range(20, 40)))]
    got = sd.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.n_words, r.n_removed) for r in got) == sorted([(41, 0), *[(44, 41)] * 1000, (5, 0), (20, 20)])
    keyed = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("coalesce(doc_id, 9223372036854775807L) AS id", "xxhash64(text) AS tkey", "text")
    assert sd.substring_spans(keyed).count() <= 8 * len(rows)   # a few spans a row, not a few for each pair of rows


def test_language_counts_are_bounded_by_rows():
    import pyarrow as pa

    from lakesmith.llm import language_id as li

    sizes = [b - a for a, b, _ in li.counts(pa.array(["a few words"] * 1000 + [None, ""]))]
    assert sum(sizes) == 1002 and max(sizes) <= li.PIECE_ROWS
