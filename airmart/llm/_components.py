"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import materialize


def components(links: DataFrame) -> DataFrame:
    """``a, b`` -> ``id, label``: the smallest id that each linked id reaches.

    Minimum labels run along links and then along the labels themselves, so a chain of length n takes about
    log n rounds. Each round is a written table; minima are combined on the map side and the joins split hot ids.
    """
    ends = links.select(F.col("a").alias("id"), F.col("b").alias("to")).union(links.select("b", "a")).distinct()
    ends = materialize(ends, "links")
    label = materialize(ends.groupBy("id").agg(F.min("to").alias("m")).select("id", F.least("id", "m").alias("label")), "labels")
    while True:
        near = ends.join(label.select(F.col("id").alias("to"), "label"), "to").groupBy("id").agg(F.min("label").alias("m"))
        low = label.join(near, "id").select("id", F.least("label", "m").alias("low"), "label")
        hop = label.select(F.col("id").alias("low"), F.col("label").alias("hop"))
        nxt = materialize(low.join(hop, "low").select("id", F.least("low", "hop").alias("new"), "label"), "labels")
        changed = not nxt.where("new <> label").isEmpty()
        label = nxt.select("id", F.col("new").alias("label"))
        if not changed:
            return label
