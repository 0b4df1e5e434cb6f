"""Incremental compaction: sizes of the packed files, what a run rewrites, and rows against the lake."""

import random
import shutil
from pathlib import Path

from lakesmith.operators.versions import latest, remove_old_versions
from lakesmith.plans.compaction import LISTED, compact_new, read_compacted


def _land(spark, folder, first, rows):
    df = spark.range(first, first + rows).selectExpr("id", "concat('text ', md5(cast(id as string))) AS t")
    df.coalesce(1).write.parquet(str(folder))


def _rows(df):
    return sorted(tuple(r) for r in df.select("id", "t").collect())


def _packs(out):
    return {p.parent: p.stat().st_size for p in Path(out).glob("pack-*/_bin=*/*.parquet")}


def test_packs_follow_the_lake(spark, tmp_path):
    lake, out, rng = tmp_path / "lake", str(tmp_path / "out"), random.Random(1)
    sizes = [*(rng.randrange(1, 400) for _ in range(25)), 6000, 9000]   # skewed: two are big
    for n, size in enumerate(sizes):
        _land(spark, lake / f"f{n} [x]", n * 10_000, size)
    files = [p.stat().st_size for p in lake.glob("*/*.parquet")]
    target = 2 * sorted(files)[-2] - 100                                # the two big ones are half the target or more
    told = compact_new(spark, str(lake), out, target)
    everything = spark.read.option("recursiveFileLookup", "true").parquet(str(lake))
    assert told["packed"] == 25 and _rows(read_compacted(spark, out)) == _rows(everything)
    listed = spark.read.schema(LISTED).parquet(f"{out}/{latest(out)[1]['listed']}").collect()
    members = {}
    for r in listed:
        members.setdefault((r.folder, r.bin), []).append(r.length)
    full = sorted(sum(v) for (f, _), v in members.items() if f)
    assert all(0.5 * target <= s <= 1.5 * target for s in full[1:]) and len(_packs(out)) == told["bins"] == len(full)
    assert sorted(r.length for r in listed if not r.folder) == sorted(files)[-2:]        # big ones stay where they are
    assert compact_new(spark, str(lake), out, target) == {"packed": 0, "bins": 0} or full[0] < 0.5 * target

    before = _packs(out)
    _land(spark, lake / "new", 900_000, 50)
    shutil.rmtree(lake / "f26 [x]")                                                       # a big one goes
    compact_new(spark, str(lake), out, target)
    everything = spark.read.option("recursiveFileLookup", "true").parquet(str(lake))
    assert _rows(read_compacted(spark, out)) == _rows(everything)
    assert all(_packs(out)[p] == s for p, s in before.items())                            # nothing is rewritten in place
    shutil.rmtree(lake / "f3 [x]")                                                        # a member of a bin goes
    told = compact_new(spark, str(lake), out, target)
    assert _rows(read_compacted(spark, out)) == _rows(spark.read.option("recursiveFileLookup", "true").parquet(str(lake)))
    assert told["packed"] < 26
    remove_old_versions(out, keep=1)
    assert _rows(read_compacted(spark, out)) == _rows(spark.read.option("recursiveFileLookup", "true").parquet(str(lake)))


def test_bins_are_of_bounded_size(spark):
    from pyspark.sql import functions as F

    from lakesmith.plans.compaction import _bins

    files = spark.range(50_000).select(F.concat(F.lit("p"), "id").alias("path"), (F.pow(F.rand(3), 8) * 499 + 1).cast("long").alias("length"))
    sums = [r.s for r in _bins(files, 1000).groupBy("bin").agg(F.sum("length").alias("s")).collect()]
    assert max(sums) <= 1500 and sum(s < 500 for s in sums) <= 5                          # the last bins of five groups
