"""A CSV file read in byte ranges gives the rows of one reader over the whole file."""

import csv
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.pandas.types import to_arrow_schema

from lakesmith.sources import _quotes as Q
from lakesmith.sources import _ranges as X
from lakesmith.sources import _records as R
from lakesmith.sources.plaincsv import read_csv, read_quote_split_csv

PLAN = to_arrow_schema(X.PLAN)


def whole(path, mode=None):
    """``(mode, rows)`` of the one-task reader."""
    out = list(R.chunks(lambda: open(path, "rb"), path, "", mode))
    rows = [r for b in out for r in b.to_pylist()]
    return rows[0]["_mode"] if rows else None, [(r["_row_no"] == -1, r["_fields"], r["_ragged"], r["_sig"]) for r in rows]


def ranged(path, size, forced=None):
    """The same by ranges, without Spark's scheduling."""
    n = len(open(path, "rb").read())
    if not n:
        return None, []   # never bigger than a range
    cuts = [(path, k, a, min(a + size, n)) for k, a in enumerate(range(0, n, size))]
    parts = pa.RecordBatch.from_arrays([pa.array([c[i] for c in cuts]) for i in range(4)], names=["path", "part", "at", "end"])
    table = pa.Table.from_batches(list(X._functions([parts])) if forced is None else [parts])
    plan = X._plan(forced, PLAN)(table).to_pylist()
    if any(odd for r in plan if r["check"] for _, _, odd in X._range_rows(r)):
        plan = [r | {"mode": R.SPLIT, "width": r["split_width"], "sig": r["split_sig"]} for r in plan]
    out = [r for p in reversed(plan) for b in R.batched(X._range_rows(p), p["path"], "", p["mode"], p["sig"]) for r in b.to_pylist()]
    out.sort(key=lambda r: r["_row_no"])
    return out[0]["_mode"] if out else None, [(r["_row_no"] == -1, r["_fields"], r["_ragged"], r["_sig"]) for r in out]


HARD = [
    b'a,b\n1,"x\ny"\n2,"p ""q"", r"\r\n3,z', b'a,b\r\n"1\r\n\r\n2",3\r\n', b'\n\n\r\n"a","b"\n"1","2,3"\n', b'"a","b"\n"1","x "y" z"\n"2","3"\n',
    b'"a","b"\n"1","2","3"\n"4","5"\n', b'a,b\n1,"open\n2,3\n', b'"a","b"\n"1","open\n"2","3"\n', b'a,b\n1,2"3\n4"",5\n', b'a,b\n1,"x"y\n2,3\n',
    b'a\n"' + b"long\n" * 40 + b'"\nz\n', b'a,b\r1,2\r3,"4\r5"\r', b"", b"\n\r\n", b"a", b'"', b'""', b'a,b\n,\n"",""\n', b'a,\xe9\n1,"\xff\n"\n', b'"' + b'""' * 30 + b'",b\n1,2\n',
]


@pytest.mark.parametrize("text", HARD)
def test_every_cut(tmp_path, text):
    p = tmp_path / "f.csv"
    p.write_bytes(text)
    for forced in (None, R.SPLIT):
        expect = whole(str(p), forced)
        for size in range(1, max(len(text), 1) + 1):
            assert ranged(str(p), size, forced) == expect, (size, forced)


@given(st.lists(st.sampled_from([b'"', b",", b"\n", b"\r\n", b"a", b"bc", b'""', b'","', b" "]), max_size=40).map(b"".join), st.integers(1, 9))
@settings(max_examples=400, deadline=None)
def test_any_text(tmp_path_factory, text, size):
    p = tmp_path_factory.mktemp("any") / "f.csv"
    p.write_bytes(text)
    assert ranged(str(p), size) == whole(str(p))


@given(st.binary(max_size=60).map(lambda b: b.translate(bytes(b'",\n\rx'[i % 5] for i in range(256)))), st.integers(0, 60))
def test_functions_compose(data, cut):
    f = Q.FUNCTIONS[Q.function_of(data)]
    a, b = Q.FUNCTIONS[Q.function_of(data[:cut])], Q.FUNCTIONS[Q.function_of(data[cut:])]
    assert f == tuple(b[s] for s in a)
    state = Q.RECORD
    for c in data:
        state = Q._STEP[int(Q._KIND[c])][state]
    assert f[Q.RECORD] == state


def test_few_functions():
    assert len(Q.FUNCTIONS) < 1 << 8 and Q.FUNCTIONS[0] == tuple(range(6))


def test_big_file_on_many_tasks(spark, tmp_path):
    """Beside small files, whose headers differ; the big file's ranges are parsed by tasks of their own."""
    rng = random.Random(7)
    with open(tmp_path / "big.csv", "w", encoding="latin-1", newline="") as f:
        w = csv.writer(f)
        w.writerow(["id", "note", "n"])
        for i in range(4000):
            w.writerow([i, "".join(rng.choice(['"', ",", "\n", "é", "word ", "\r\n"]) for _ in range(rng.randrange(30))), i % 7] + ["more"] * (i % 500 == 3))
    (tmp_path / "small.csv").write_bytes(b"n,id\n5,small\n")
    (tmp_path / "open.csv").write_bytes(b'id,note\n1,"never closed\n' + b"2,x\n" * 3000)
    (tmp_path / "split.csv").write_bytes(b'"id","note"\n' + b'"3","a "b", c"\n' * 3000)
    (tmp_path / "empty.csv").write_bytes(b"")
    key = lambda r: tuple(map(str, r))
    expect = sorted(read_csv(spark, str(tmp_path)).collect(), key=key)
    for size in (1 << 13, 1 << 15):
        assert sorted(read_csv(spark, str(tmp_path), range_bytes=size).collect(), key=key) == expect
    assert len(expect) == 4000 + 1 + 3001 + 3000
    lines = sorted(read_quote_split_csv(spark, str(tmp_path), "split.csv", range_bytes=1 << 12).collect())
    assert lines == sorted(read_quote_split_csv(spark, str(tmp_path), "split.csv").collect()) and lines[0].note == 'a "b", c'


def test_ranges_share_tasks(spark, tmp_path):
    """Many small ranges make no more tasks than their bytes fill (or the cluster has slots)."""
    p = tmp_path / "f.csv"
    p.write_bytes(b'id,note\n' + b"".join(b'%d,"a\n""b"""\n' % i for i in range(400)))
    files = spark.createDataFrame([(str(p), p.stat().st_size)], "path string, length bigint")
    raw = X.extract_ranges(files, 64)
    assert raw.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    rows = [tuple(r._fields) for r in raw.orderBy("_row_no").collect()]
    assert rows == [("id", "note")] + [(str(i), 'a\n"b"') for i in range(400)]
