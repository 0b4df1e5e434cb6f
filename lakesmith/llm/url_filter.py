"""URL filters: rules first, then a character language-model ratio (DataFrame operations only).

Two smoothed variable-order Markov models over URL characters, one of accepted
and one of rejected URLs, score each remaining URL: the difference of their
log-likelihoods per character.  A character's probability interpolates all
context lengths up to ``ORDER`` (Witten-Bell).  URLs that a rule decides train
the models, but for a quarter that calibrates the threshold.

Probabilities are worked out once per distinct n-gram, in tables built up from
the shortest context; only (URL, n-gram) rows are joined to them, so no table
is broadcast and repeated URLs are scored once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesmith.llm.exact_dedup import LOWER, UPPER
from lakesmith.session import fresh_dir

#: longest context, in characters
ORDER = 5
#: probability of a character before any is seen
UNIFORM = 1.0 / 256
#: marks before and after a URL; a URL that has them itself only shares their counts
START, END = "\u0002", "\u0003"
#: histogram bins of the calibration, per unit of the score, and its range
BINS, RANGE = 100, 10

Rule = tuple[str, str]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first ``://`` and path before ``?`` or ``#``; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)([^?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, "^([^/?#]*)([^?#]*)", 2)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits (its host or a subdomain, and the start of the path) and its action; else null.

    Of rules of one length, a block goes before an allow.
    """
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block")):
        site, slash, rest = text.partition("/")
        fits = ((host == site) | F.endswith(host, F.lit("." + site))) & F.startswith(path, F.lit(slash + rest))
        rule, action = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def grams(urls: DataFrame) -> DataFrame:
    """One row per character of ``url`` and its end: the ``ORDER`` characters before it and itself."""
    chars = F.concat(F.array_repeat(F.lit(START), ORDER), F.filter(F.split("url", ""), lambda c: c != ""), F.array(F.lit(END)))
    shifted = [F.slice(F.col("chars"), F.lit(k + 1), F.size("chars") - ORDER).alias(f"c{k}") for k in range(ORDER + 1)]
    return (
        urls.withColumn("chars", chars).withColumn("z", F.explode(F.arrays_zip(*shifted)))
        .withColumn("gram", F.concat(*[F.col(f"z.c{k}") for k in range(ORDER + 1)])).drop("chars", "z")
    )


def model(counted: DataFrame) -> DataFrame:
    """``(gram, log_ratio)`` from ``counted(gram, yes, no)``: log P(character | context), accepted over rejected."""
    levels = {ORDER: counted}
    for k in range(ORDER - 1, -1, -1):
        levels[k] = levels[k + 1].groupBy(F.right("gram", F.lit(k + 1)).alias("gram")).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    known = None
    for k in range(ORDER + 1):
        here = levels[k].withColumn("ctx", F.expr(f"left(gram, {k})"))
        seen = here.groupBy("ctx").agg(
            F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"), F.count_if(F.col("yes") > 0).alias("kinds_yes"), F.count_if(F.col("no") > 0).alias("kinds_no"),
        )
        here = here.join(seen, "ctx")
        if known is None:
            here = here.withColumns({"p_yes": F.lit(UNIFORM), "p_no": F.lit(UNIFORM)})
        else:
            here = here.withColumn("short", F.right("gram", F.lit(k))).join(known.withColumnRenamed("gram", "short"), "short")
        for side in ("yes", "no"):
            n, total, kinds, p = (F.col(c + side) for c in ("", "all_", "kinds_", "p_"))
            here = here.withColumn(f"p_{side}", F.when(total > 0, (n + kinds * p) / (total + kinds)).otherwise(p))
        known = here.select("gram", "p_yes", "p_no")
    return known.select("gram", (F.log("p_yes") - F.log("p_no")).alias("log_ratio"))


def threshold(scored: DataFrame) -> float:
    """Score that parts the accepted from the rejected best (mean of both hit rates); 0 if either is missing.

    ``scored(score, yes)`` is first reduced to a histogram of fixed size.
    """
    step = F.greatest(F.lit(-RANGE * BINS), F.least(F.lit(RANGE * BINS), F.floor(F.col("score") * BINS)))
    bins = {b: (y, n) for b, y, n in scored.groupBy(step.cast("int").alias("bin")).agg(F.count_if("yes"), F.count_if(~F.col("yes"))).collect()}
    yes, no = sum(y for y, _ in bins.values()), sum(n for _, n in bins.values())
    if not yes or not no:
        return 0.0
    best, below_yes, below_no = (0.5, 0.0, 0.0), 0, 0
    for b in sorted(bins):
        good = ((yes - below_yes) / yes + below_no / no) / 2     # from this bin on: accepted
        best = max(best, (good, -abs(b / BINS), b / BINS))
        below_yes, below_no = below_yes + bins[b][0], below_no + bins[b][1]
    return best[2]


def url_filter(pages: DataFrame, rules: list[Rule], *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: id, ``url``, ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``score``.

    ``rules`` are ``(action, "host/path")``.  A null URL counts as empty: no
    host, no path, no rule, judged by the models alone, as are URLs without
    ``://``.  If no rule accepts (or rejects) any URL, that model is uniform
    and the threshold is 0.  A score on the threshold allows.  Repeated URLs
    get equal verdicts; other columns are not read; an empty table gives an
    empty result.
    """
    spark = pages.sparkSession
    path = fresh_dir(spark, "url_filter")
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"))
    host, rest = host_path(F.col("url"))
    urls = rows.select("url").distinct().select("url", host.alias("host"), rest.alias("path"))
    rule, action = matching_rule(F.col("host"), F.col("path"), rules)
    urls.select("*", rule.alias("rule"), action.alias("action"), (F.crc32("url") % 4 == 0).alias("calibrates")).write.parquet(f"{path}/urls")
    urls = spark.read.parquet(f"{path}/urls")

    spelt = grams(urls.select("url", "action", "calibrates"))
    trains = ~F.col("calibrates")
    counted = spelt.groupBy("gram").agg(
        F.count_if(trains & (F.col("action") == "allow")).alias("yes"), F.count_if(trains & (F.col("action") == "block")).alias("no"),
    )
    counted.write.parquet(f"{path}/grams")
    model(spark.read.parquet(f"{path}/grams")).write.parquet(f"{path}/model")
    (
        spelt.select("url", "gram").hint("merge").join(spark.read.parquet(f"{path}/model"), "gram")
        .groupBy("url").agg(F.avg("log_ratio").alias("score")).write.parquet(f"{path}/scores")
    )
    scored = urls.hint("merge").join(spark.read.parquet(f"{path}/scores"), "url")
    least = threshold(scored.where("calibrates and action is not null").select("score", (F.col("action") == "allow").alias("yes")))
    verdict = F.coalesce("action", F.when(F.col("score") >= least, "allow").otherwise("block"))
    scored.select("url", "host", "path", "rule", verdict.alias("verdict"), "score").write.parquet(f"{path}/verdicts")
    return rows.hint("merge").join(spark.read.parquet(f"{path}/verdicts"), "url").select(F.col("id").alias(id_col), "url", "host", "path", "rule", "verdict", "score")
