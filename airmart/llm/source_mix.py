"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Every source gets a share of ``ratio`` times all words by its weight, capped at ``max_epochs`` times its own
size; what a capped source cannot use is shared again by weight until no source is above its cap. A source's
target is met by complete epochs of all its documents first and then by a weighted sample: each document
draws an exponential key ``-ln(u) / quality`` (``u`` from the MD5 of its id, so reruns agree), documents are
sorted by key, and the prefix that fills the rest of the target is taken. The document on the border is taken
if at least half of it fits, so a source misses its target by at most half a document.

Hot sources: keys are cut into ``BUCKETS`` ranges whose word sums are pre-aggregated on the map side. Ranges
wholly below or above a source's border need no sort; only the documents of the one border range of each
source are sorted.

Edge cases: a null text has size 0 (taken 0); a null source is a source of its own, after all others; an
empty source (no words) has target 0. A null id draws the key of the text ``null``. Rows with equal ids draw
equal keys and are ordered by size; wholly equal rows are taken one by one. Labels with several rows for an
id count with the best quality. Only the named columns are read. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._tables import materialize

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)    # repeating, over the sources by code point
RATIO = 1.5            # words of the mix for each word of the input
MAX_EPOCHS = 2
BUCKETS = 4096
QUALITY = {1: 1.0, 0: 0.5}  # sampling weight by label; DEFAULT_QUALITY without one
DEFAULT_QUALITY = 0.75


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, ratio: float = RATIO,
                   max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``source, source_size`` -> plus ``target``. One row per source, so one ordered pass over them is enough:
    with sources by cap/weight, the water level is the first ``(total - caps before) / weights left`` that does
    not lift the source above its cap."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cyc = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    rated = sizes.select("source", "source_size", cyc.alias("weight"), (F.col("source_size") * F.lit(float(max_epochs))).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = rated.select("source", "source_size", "weight", "cap",
                          (F.sum("source_size").over(all_rows) * F.lit(float(ratio)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("left"),
                          (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weights"))
    level = F.when(F.col("left") / F.col("weights") * F.col("weight") <= F.col("cap"), F.col("left") / F.col("weights"))
    everything = Window.partitionBy(F.lit(1)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return filled.select("source", "source_size", F.least(
        "cap", F.coalesce(F.first(level, ignorenulls=True).over(everything) * F.col("weight"), F.col("cap"))).alias("target"))


def mix_plan(docs: DataFrame, quality: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", weights: Sequence[float] = WEIGHTS, ratio: float = RATIO,
             max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target`` and ``taken`` (words, repeats counted).

    ``quality`` has an id column of the same name and a column ``quality`` (the keys of ``QUALITY``)."""
    d = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                    F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rate = F.lit(DEFAULT_QUALITY)
    if quality is not None:
        best = quality.select(F.col(id_col).alias("id"), F.col("quality").cast("int").alias("q")).groupBy("id").agg(F.max("q").alias("q"))
        d = d.join(best, "id", "left")
        for label, value in QUALITY.items():
            rate = F.when(F.col("q") == label, F.lit(value)).otherwise(rate)
    digest = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("null")))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    key = -F.log(u) / rate
    d = d.select("id", "source", "size", key.alias("key"), F.floor((1 - F.exp(-key)) * BUCKETS).cast("int").alias("bucket"))
    d = materialize(d, "mix-keys")

    sums = d.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, ratio, max_epochs)
    targets = targets.withColumn("epochs", F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("long"))
    targets = targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    reach = sums.withColumn("before", F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) - F.col("words"))
    t, s = targets.alias("t"), reach.alias("s")
    # Per source: the last range that begins below the rest of the target holds the border.
    border = (t.join(s, F.col("t.source").eqNullSafe(F.col("s.source")), "left")
              .groupBy("t.source", "source_size", "target", "epochs", "rest")
              .agg(F.max(F.when(F.col("before") < F.col("rest"), F.struct("bucket", "before"))).alias("b"))
              .select(F.col("source").alias("of"), "source_size", "target", "epochs", "rest",
                      F.coalesce("b.bucket", F.lit(-1)).alias("border"), F.coalesce("b.before", F.lit(0)).alias("before")))
    j = d.join(border, F.col("source").eqNullSafe(F.col("of")))
    cols = [F.col("id").alias(id_col), "size", "source_size", "target"]
    whole = j.where(F.col("bucket") != F.col("border")).select(
        *cols, (F.col("size") * (F.col("epochs") + (F.col("bucket") < F.col("border")).cast("long"))).alias("taken"))
    run = Window.partitionBy("source").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum("size").over(run), F.lit(0))
    edge = (j.where(F.col("bucket") == F.col("border")).withColumn("at", at).select(
        *cols, (F.col("size") * (F.col("epochs") + ((F.col("at") < F.col("rest")) & (F.col("at") + F.col("size") / 2 <= F.col("rest"))).cast("long"))).alias("taken")))
    return whole.unionByName(edge)
