"""URL filter: rules first, then a character language-model ratio (DataFrame functions only).

A rule is a host and a path prefix; it fits its host and all subdomains, and the longest fitting rule wins.
URLs that a rule decides train two smoothed variable-order Markov models over characters (contexts of 2, 1
and 0 characters, each interpolated with the next shorter one): one of accepted and one of rejected URLs. All
other URLs are judged by the length-normalised difference of the two log-likelihoods against a threshold
calibrated on a held-out fifth of the decided URLs (halfway between the means of the two classes).

Size bound: characters are mapped to ``ALPHABET``, so the model has ``K ** 3`` entries (``ALPHABET`` and an edge mark: 42, so 74,088)
whatever the input; only this table is broadcast. Counting and scoring pre-aggregate on the map side.

Edge cases: a null URL or one without ``://`` has empty host and path and no rule; a null or empty URL scores
0. Repeated rows are judged once and returned as often as they came. Without decided URLs of either class the
models are equal, the threshold is 0 and every other URL is allowed. Only the named columns are read; an
empty table gives an empty one.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._tables import materialize

# Rules as given (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
ALPHABET = string.ascii_lowercase + "0./-_?=&%:#~+@" + "*"  # 0: any digit, *: anything else
PAD = 0                   # before the first character
K = len(ALPHABET) + 1
LAMBDA = 2.0              # weight of the shorter context
FOLDS = 5                 # one fold calibrates


def url_parts(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    u = F.col(url)
    at = F.locate("://", u)
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as text) and its verdict; nulls if none."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _grams(df: DataFrame, url: str = "url") -> DataFrame:
    """One row per character of each URL: ``code`` of the character and the two before it, and ``n``, the
    characters of the URL (one row with a null code for an empty URL)."""
    symbols = F.regexp_replace(F.regexp_replace(F.lower(F.col(url)), "[0-9]", "0"), "[^a-z0./\\-_?=&%:#~+@]", "*")
    df = df.withColumn("_s", F.transform(
        F.filter(F.split(F.coalesce(symbols, F.lit("")), ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c)))
    df = df.withColumn("_p", F.concat(F.array(F.lit(PAD), F.lit(PAD)), F.col("_s")))
    codes = F.transform(F.col("_s"), lambda c, i: (F.get("_p", i) * K + F.get("_p", i + 1)) * K + c)
    return df.withColumn("n", F.size("_s")).withColumn("_c", codes).withColumn("code", F.explode_outer("_c")).drop("_s", "_p", "_c")


def ratio_model(grams: DataFrame) -> DataFrame:
    """``code, verdict`` rows -> ``code, ratio``: log accepted minus log rejected probability of each character
    after its two predecessors, for every code of the alphabet."""
    spark = grams.sparkSession
    counts = grams.where(F.col("code").isNotNull()).groupBy("code").agg(
        *(F.sum((F.col("verdict") == v).cast("long")).alias(v) for v in ("allow", "block")))
    grid = spark.range(K ** 3).select(F.col("id").cast("int").alias("code")).join(counts, "code", "left").fillna(0)
    grid = grid.select("code", "allow", "block", F.expr(f"code div {K * K}").alias("a"), F.expr(f"(code div {K}) % {K}").alias("b"), (F.col("code") % K).alias("c"))
    logs = {}
    for v in ("allow", "block"):
        n = F.col(v)
        grid = grid.withColumns({
            "n_ab": F.sum(n).over(Window.partitionBy("a", "b")), "n_bc": F.sum(n).over(Window.partitionBy("b", "c")),
            "n_b": F.sum(n).over(Window.partitionBy("b")), "n_c": F.sum(n).over(Window.partitionBy("c")),
            "n_all": F.sum(n).over(Window.partitionBy(F.lit(0)))})
        p0 = (F.col("n_c") + LAMBDA / K) / (F.col("n_all") + LAMBDA)
        p1 = (F.col("n_bc") + p0 * LAMBDA) / (F.col("n_b") + LAMBDA)
        p2 = (n + p1 * LAMBDA) / (F.col("n_ab") + LAMBDA)
        logs[v] = f"log_{v}"
        grid = grid.withColumn(logs[v], F.log(p2))
    return grid.select("code", (F.col("log_allow") - F.col("log_block")).alias("ratio"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``verdict``, and ``score`` where no rule decides."""
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    host, path = url_parts()
    src = src.select("id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    src = src.select("id", "url", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
    fold = F.conv(F.substring(F.md5("url"), 1, 4), 16, 10).cast("int") % FOLDS
    decided = src.where(F.col("rule").isNotNull()).select("url", "verdict")

    model = F.broadcast(materialize(ratio_model(_grams(decided.where(fold != 0))), "url-model"))  # K**3 rows
    mean = lambda grams, *by: grams.join(model, "code", "left").groupBy(*by)
    score = F.coalesce(F.sum("ratio") / F.count("ratio"), F.lit(0.0))
    held = mean(_grams(decided.where(fold == 0)), "url", "verdict").agg(score.alias("score"))
    means = held.agg(*(F.avg(F.when(F.col("verdict") == v, F.col("score"))).alias(v) for v in ("allow", "block")))
    limit = materialize(means.select(F.coalesce((F.col("allow") + F.col("block")) / 2, F.lit(0.0)).alias("t")), "url-limit")

    ruled = src.where(F.col("rule").isNotNull()).select(
        F.col("id").alias(id_col), "host", "path", "rule", "verdict", F.lit(None).cast("double").alias("score"))
    # Equal rows meet in one group: characters (or empty URLs) counted together give the repeats back.
    free = mean(_grams(src.where(F.col("rule").isNull())), "id", "url", "host", "path", "n").agg(
        score.alias("score"), F.expr("cast(count(*) div greatest(n, 1) as int)").alias("times"))
    free = free.withColumn("again", F.explode(F.sequence(F.lit(1), "times"))).select(
        F.col("id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"),
        F.when(F.col("score") >= limit.scalar(), "allow").otherwise("block").alias("verdict"), "score")
    return ruled.unionByName(free)
