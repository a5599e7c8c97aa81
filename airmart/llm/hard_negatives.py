"""Hard-negative mining by slot-decomposed selection.

Every anchor has up to ``POSITIVES`` positives, its best other rows of the same label. A positive with score ``p`` asks
for the best rows of other labels with scores from 30 % to 90 % of ``p``. These windows overlap; their upper limits,
in falling order, cut the scores of an anchor into disjoint slots. Combiners keep the ``NEGATIVES`` best of each slot
only, and the window of a positive is answered by merging the slots from its own downwards until its list is full
or its lower limit is reached: no window needs a row that its slot did not keep.

Components are ``floor(256 * x)``, so scores are exact integers: products of blocks in doubles where no sum can pass
2**53, else in whole numbers of any length (a score beyond 64 bits is held at the nearest end of the range).

Scale: rows and anchors travel in packed blocks. Anchors are dealt to groups of ``GROUP_BYTES`` at most, every group
meets all blocks of rows on a grid of keys, and a task keeps the lists of the anchors of its group. The rows are
shuffled once for each group of anchors, which is what comparing every anchor with every row asks for.

Edge cases: rows with a null label, a null vector, or a null or non-finite component take no part. A row with a null
id does; it is no anchor, keeps its label and comes last among ties. Repeated rows are rows of their own: an anchor
is only not its own positive, and each repeated anchor has its own lists. Vectors meet vectors of their own length
only; empty ones have score 0. Other columns are not read. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._tables import materialize, schema, width

POSITIVES, NEGATIVES = 5, 10
ANCHOR_EVERY, SHIFT_EVERY, LABELS = 100, 7, 10
BLOCK_BYTES = 1 << 19   # components of a packed block
GROUP_BYTES = 1 << 25   # components of the anchors that a task holds lists for
_LEAST = np.iinfo(np.int64).min
_BLOCK = schema("dim long, rows binary, ids binary, nulls binary, labels binary, q binary, limits binary")


def prepared(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``row, id, label, q``: the rows that take part, numbered, with their integer components."""
    bad = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    label = F.col(label_col).cast("long")
    shifted = F.when(F.col(id_col) % SHIFT_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    rows = vectors.where(F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & ~bad)
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), shifted.alias("label"),
                       F.transform(vec_col, lambda x: F.floor(x.cast("double") * 256)).alias("q"))


def _packed(rows: DataFrame) -> DataFrame:
    """``row, id, label, q, limits`` -> blocks of vectors of one length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            dims = np.asarray(pa.compute.list_value_length(col["q"])) if len(batch) else np.zeros(0, dtype=np.int32)
            numbers = {n: np.asarray(col[n].fill_null(0)) for n in ("row", "id", "label")}
            nulls = np.asarray(col["id"].is_null())
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                step = max(1, BLOCK_BYTES // (8 * max(1, int(dim))))
                for part in (at[i:i + step] for i in range(0, len(at), step)):
                    take = pa.array(part)
                    q, limits = (np.asarray(col[n].take(take).flatten(), dtype=np.int64) for n in ("q", "limits"))
                    yield pa.RecordBatch.from_arrays([pa.array([int(dim)]), *(pa.array([x.tobytes()], type=pa.binary()) for x in (
                        numbers["row"][part], numbers["id"][part], nulls[part], numbers["label"][part], q, limits))], names=_BLOCK.names)

    return rows.mapInArrow(run, _BLOCK)


class Block:
    """A packed block, unpacked."""

    def __init__(self, dim: int, rows: bytes, ids: bytes, nulls: bytes, labels: bytes, q: bytes, limits: bytes):
        self.rows, self.ids, self.labels = (np.frombuffer(x, dtype=np.int64) for x in (rows, ids, labels))
        self.nulls = np.frombuffer(nulls, dtype=bool)
        self.q = np.frombuffer(q, dtype=np.int64).reshape(len(self.rows), dim)
        self.limits = np.frombuffer(limits, dtype=np.int64).reshape(len(self.rows), -1)
        self.top = max(int(self.q.max(initial=0)), -int(self.q.min(initial=0)))


def scores(a: Block, b: Block) -> np.ndarray:
    """Inner products of all rows of two blocks, exact within 64 bits."""
    if a.q.shape[1] * a.top * b.top < 1 << 53:
        return (a.q.astype(np.float64) @ b.q.T.astype(np.float64)).astype(np.int64)
    whole = a.q.astype(object) @ b.q.T.astype(object)
    return np.clip(whole, int(_LEAST), -int(_LEAST) - 1).astype(np.int64)


class Best:
    """The ``k`` best (score falling, id rising, null ids last) of each list, a list having a number."""

    def __init__(self, k: int):
        self.k = k
        self.cols = [np.zeros(0, dtype=t) for t in (np.int64, np.int64, bool, np.int64, np.int64)]  # list, score, null, id, row

    def add(self, lists: np.ndarray, s: np.ndarray, b: Block, which: np.ndarray) -> None:
        """Entries ``which`` of the scores ``s`` (one line for each of ``lists``) of the rows of ``b``."""
        masked = np.where(which, s, _LEAST)
        if s.shape[1] > self.k:  # only what ties with the k-th best of its line or beats it goes on
            which = which & (masked >= np.partition(masked, -self.k, axis=1)[:, -self.k][:, None])
        line, at = np.nonzero(which)
        new = (lists[line], s[line, at], b.nulls[at], b.ids[at], b.rows[at])
        cols = [np.concatenate(x) for x in zip(self.cols, new)]
        order = np.lexsort((cols[4], cols[3], cols[2], ~cols[1], cols[0]))
        cols = [c[order] for c in cols]
        first = np.flatnonzero(np.concatenate(([True], cols[0][1:] != cols[0][:-1]))) if len(order) else np.zeros(0, dtype=np.int64)
        rank = np.arange(len(order)) - np.repeat(first, np.diff(np.concatenate((first, [len(order)]))))
        self.cols = [c[rank < self.k] for c in cols]


def _grid(anchors: DataFrame, rows: DataFrame, groups: int, cells: int) -> DataFrame:
    """Every block of anchors beside every block of rows: anchors are dealt to ``groups``, rows to ``cells``."""
    a = anchors.select(*(F.col(c).alias(f"a_{c}") for c in _BLOCK.names)).withColumn("g", F.pmod(F.xxhash64("a_rows"), F.lit(groups)))
    a = a.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))).withColumn("c", F.col("c").cast("long"))
    b = rows.withColumn("c", F.pmod(F.xxhash64("rows"), F.lit(cells))).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    b = b.withColumn("g", F.col("g").cast("long"))
    both = b.hint("merge").join(a, ["g", "c"]).where(F.col("dim") == F.col("a_dim"))
    return both.select(*(f"a_{c}" for c in _BLOCK.names), *_BLOCK.names)


def _same_label(a: Block, b: Block) -> np.ndarray:
    return a.labels[:, None] == b.labels[None, :]


def _selected(grid: DataFrame, slots: bool) -> DataFrame:
    """``anchor, slot, score, id, row``: what each task keeps, the best positives (slot 0) or the best of each slot."""
    out = schema("anchor long, slot long, score long, id long, row long")
    n, k, n_slots = len(_BLOCK.names), NEGATIVES if slots else POSITIVES, POSITIVES if slots else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple[Block, Best]] = {}
        for batch in batches:
            for i in range(len(batch)):
                key = batch.column(1)[i].as_py()
                if key not in held:
                    held[key] = Block(*(batch.column(j)[i].as_py() for j in range(n))), Best(k)
                (a, best), b = held[key], Block(*(batch.column(j)[i].as_py() for j in range(n, 2 * n)))
                s, same, number = scores(a, b), _same_label(a, b), np.arange(len(a.rows))
                if not slots:
                    best.add(number, s, b, same & (a.rows[:, None] != b.rows[None, :]))
                    continue
                upper, lower = a.limits[:, :POSITIVES], a.limits[:, POSITIVES:]
                for j in range(POSITIVES):
                    inside = ~same & (s <= upper[:, j, None]) & (s >= lower[:, j, None])
                    if j + 1 < POSITIVES:
                        inside &= s > upper[:, j + 1, None]
                    if inside.any():
                        best.add(number * POSITIVES + j, s, b, inside)
        for a, best in held.values():
            number, score, null, ids, rows = best.cols
            yield pa.RecordBatch.from_arrays([pa.array(a.rows[number // n_slots]), pa.array(number % n_slots), pa.array(score),
                                              pa.array(ids, mask=null), pa.array(rows)], names=out.names)

    return grid.mapInArrow(run, out)


def _first(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k best of each list, and their ``rank`` from 1."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor (an id divisible by
    ``ANCHOR_EVERY``) and each of its positives, the best rows of other labels within the positive's window."""
    spark = vectors.sparkSession
    rows = materialize(prepared(vectors, id_col, vec_col, label_col), "mining-rows")
    anchors = rows.where(F.col("id") % ANCHOR_EVERY == 0)
    held = anchors.agg(F.coalesce(F.sum(F.size("q")), F.lit(0)).alias("n")).first()["n"] * 8
    groups = max(1, -(-held // GROUP_BYTES))
    cells = max(1, -(-2 * width(spark) // groups))
    blocks = materialize(_packed(rows.withColumn("limits", F.array().cast("array<long>"))), "mining-blocks")
    plain = _packed(anchors.withColumn("limits", F.array().cast("array<long>")).repartition(groups, "row"))
    positives = materialize(_first(_selected(_grid(plain, blocks, groups, cells), False), ["anchor"], POSITIVES), "mining-positives")

    # Whole-number limits: 100 * s <= 90 * p and 100 * s >= 30 * p without products that pass 64 bits.
    upper = F.expr("score - (score div 10 + CASE WHEN score % 10 > 0 THEN 1 ELSE 0 END)")
    lower = F.expr("3 * (score div 10) + CAST(ceil(3 * (score % 10) / 10.0) AS BIGINT)")
    positives = positives.withColumns({"upper": upper, "lower": lower})
    none = F.array_repeat(F.lit(int(_LEAST)), POSITIVES)
    by_rank = lambda c: F.slice(F.concat(F.transform(F.sort_array(F.collect_list(F.struct("rank", c))), lambda x: x[c]), none), 1, POSITIVES)
    limits = positives.groupBy(F.col("anchor").alias("row")).agg(by_rank("upper").alias("u"), by_rank("lower").alias("l"))
    limited = anchors.join(limits, "row").select("row", "id", "label", "q", F.concat("u", "l").alias("limits"))
    kept = _first(_selected(_grid(_packed(limited.repartition(groups, "row")), blocks, groups, cells), True), ["anchor", "slot"], NEGATIVES)

    # Suffix merges: at most POSITIVES * NEGATIVES entries an anchor, the best first.
    falling = F.struct(F.bitwise_not("score").alias("down"), F.col("id").isNull().alias("null"), "id", "row", "slot", "score")
    merged = kept.groupBy("anchor").agg(F.sort_array(F.collect_list(falling)).alias("falling"))
    asked = positives.select("anchor", F.col("rank").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "lower")
    own = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    window = F.expr(f"slice(filter(falling, e -> e.slot >= positive - 1 AND e.score >= lower), 1, {NEGATIVES})")
    return (asked.join(merged, "anchor").join(own, "anchor").select("anchor_id", "positive_id", "positive_score", F.posexplode(window).alias("at", "e"))
            .select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.id").alias("negative_id"),
                    "positive_score", F.col("e.score").alias("negative_score")))
