"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

A document is contaminated by a benchmark item when some passage of it is within ``MAX_EDITS`` word edits per
item word (floor) of the item. Words are lower-cased (A-Z) and ASCII punctuation separates them.

Item-sized windows are taken where the document holds one of the item's ``k + 1`` pieces unchanged (k edits
cannot touch all of them, so no passage is lost). Each window and each item is embedded ``REPEATS`` times by
the CGK random walk (three steps per word; a random bit of the step and the word decides if the walk goes on),
which turns edit distance into Hamming distance; ``SAMPLES`` sampled positions of an embedding form one LSH
key, and a window that shares any key with its item is a candidate. Candidates are verified with the exact
edit distance (bit-parallel, free ends, the window widened by k words on both sides).

The benchmark is the stated query set: it comes in blocks of at most ``BLOCK_WORDS`` words (or one item), which
go to the tasks with the function; documents are scanned in place, without shuffle.

Edge cases: null or empty texts of documents or items match nothing. Repeated rows and null ids are judged
row by row; an item id that occurs twice is two items. Items of fewer words than allow an edit must occur
exactly. Texts of any length are scanned whole. Other columns are passed through or not read, whatever their
names; empty tables on either side give no matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ._tables import materialize
from ._words import _LOWER, Words, grams, mix, slices

MAX_EDITS = 0.2
REPEATS, SAMPLES = 32, 3   # recall of CGK keys at 20 % edits is above 0.99 (tests)
STRETCH = 3                # walk steps per word
BLOCK_WORDS = 200_000
_U = np.uint64
_FOLD = _LOWER.copy()
_FOLD[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32


def fold_words(data: np.ndarray, off: np.ndarray) -> Words:
    """Words without case and ASCII punctuation."""
    return Words(_FOLD[data], off)


def cgk_keys(h: np.ndarray, start: np.ndarray, length: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """LSH keys (windows x REPEATS) of the windows ``h[start:start + length]`` in texts ``h[lo:hi]``.

    The walk of each window and repeat reads its word, moves on by a random bit of (repeat, step, word), and
    reads the empty symbol outside its text and after its end. A key hashes the words read at SAMPLES steps, drawn
    per repeat and length; a window is as long as its item also where it reaches over a border of its text, so
    both are read at the same steps."""
    m = len(start)
    keys = np.zeros((m, REPEATS), dtype=np.uint64)
    if not m:
        return keys
    at = np.zeros((m, REPEATS), dtype=np.int64)
    steps = STRETCH * length
    stop = np.minimum(start + length, hi)[:, None]
    rep = np.arange(REPEATS, dtype=np.uint64)
    pick = mix(mix(rep, 31)[None, :, None] + length[:, None, None].astype(np.uint64) * _U(64) + np.arange(SAMPLES, dtype=np.uint64)[None, None, :], 32)
    pick = (pick % steps[:, None, None].astype(np.uint64)).astype(np.int64)
    for step in range(int(steps.max())):
        here = start[:, None] + at
        over = here >= stop
        word = np.where(over | (here < lo[:, None]), _U(0), h[np.clip(here, 0, len(h) - 1)])
        hit = (pick == step).any(axis=2)
        keys[hit] = mix(keys[hit] + word[hit], 33)
        bit = (mix(word + mix(rep + _U(step * 64), 34)[None, :], 35) & _U(1)).astype(np.int64)
        at += np.where(over, 0, bit)
    return keys


def edit_match(item: list[int], text: list[int]) -> tuple[int, int]:
    """(least edit distance of the item to any run of the text, end of the first such run): bit-parallel."""
    m = len(item)
    peq: dict[int, int] = {}
    for i, x in enumerate(item):
        peq[x] = peq.get(x, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, x in enumerate(text, 1):
        eq = peq.get(x, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        score += bool(ph & top) - bool(mh & top)
        if score < best:
            best, end = score, j
        ph, mh = ph << 1 & full, mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
    return best, end


class Items:
    """A block of benchmark items, ready for lookup."""

    def __init__(self, rows: list[tuple[object, bytes]], max_edits: float = MAX_EDITS):
        self.ids = [i for i, _ in rows]
        raw = [t for _, t in rows]
        w = fold_words(np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in raw]))).astype(np.int64))
        h = w.hashes()
        self.words = [h[w.first[i]:w.first[i + 1]] for i in range(len(raw))]
        self.n = np.array([len(x) for x in self.words], dtype=np.int64)
        self.k = np.floor(self.n * max_edits + 1e-9).astype(np.int64)
        live = np.flatnonzero(self.n > 0)
        self.keys = np.zeros((len(raw), REPEATS), dtype=np.uint64)
        self.keys[live] = cgk_keys(h, w.first[live], self.n[live], w.first[live], w.first[live + 1])
        pieces: dict[int, list[tuple[int, int, int]]] = {}
        for i in live:
            cuts = np.linspace(0, self.n[i], self.k[i] + 2).astype(np.int64)
            for a, b in zip(cuts[:-1], cuts[1:]):
                pieces.setdefault(int(b - a), []).append((int(grams(self.words[i][a:b], int(b - a))[0]), int(i), int(a)))
        self.pieces = {}
        for size, rows_of in pieces.items():
            rows_of.sort()
            hashes = np.array([x[0] for x in rows_of], dtype=np.uint64)
            seen = np.zeros(1 << 20, dtype=bool)
            seen[(hashes >> _U(44)).astype(np.int64)] = True
            self.pieces[size] = (seen, hashes, np.array([x[1] for x in rows_of]), np.array([x[2] for x in rows_of]))

    def windows(self, w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, row, start word) of the item-sized windows of a slice around unchanged pieces; a window may begin
        before its text and end after it."""
        items, rows, starts = [], [], []
        for size, (seen, hashes, item, offset) in self.pieces.items():
            g = grams(h, size)
            if not len(g):
                continue
            at = np.flatnonzero(seen[(g >> _U(44)).astype(np.int64)])
            at = at[w.rows_left()[at] >= size]
            lo, hi = np.searchsorted(hashes, g[at], "left"), np.searchsorted(hashes, g[at], "right")
            many = hi - lo
            at, lo = np.repeat(at, many), np.repeat(lo, many)
            which = lo + np.arange(len(lo)) - np.repeat(np.cumsum(many) - many, many)
            items.append(item[which])
            rows.append(w.doc[at])
            starts.append(at - offset[which])
        if not items:
            return tuple(np.zeros((3, 0), dtype=np.int64))
        return tuple(np.unique(np.stack([np.concatenate(x) for x in (items, rows, starts)]), axis=1))

    def matches(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, distance, first word, end word) of the best passage for each contaminated (row, item)."""
        w = fold_words(data, off)
        h = w.hashes()
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        found = self.windows(w, h)
        for a in range(0, len(found[0]), 2048):
            item, row, start = (x[a:a + 2048] for x in found)
            stop = w.first[row + 1]
            keys = cgk_keys(h, start, self.n[item], w.first[row], stop)
            for i in np.flatnonzero((keys == self.keys[item]).any(axis=1)):
                it, r = int(item[i]), int(row[i])
                k = int(self.k[it])
                lo, hi = max(int(start[i]) - k, int(w.first[r])), min(int(start[i] + self.n[it]) + k, int(stop[i]))
                if (r, it) in best and best[r, it][0] == 0:
                    continue
                words, text = self.words[it].tolist(), h[lo:hi].tolist()
                d, end = edit_match(words, text)
                if d <= k and ((r, it) not in best or d < best[r, it][0]):
                    _, size = edit_match(words[::-1], text[:end][::-1])
                    first = lo + end - size - int(w.first[r])
                    best[r, it] = (d, first, lo + end - int(w.first[r]))
        return [(r, i, *v) for (r, i), v in best.items()]


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", max_edits: float = MAX_EDITS) -> Iterator[Items]:
    """The query set in blocks of bounded size; the driver holds one at a time."""
    rows: list[tuple[object, bytes]] = []
    size = 0
    for r in benchmark.select(F.col(id_col), F.col(text_col)).where(F.col(text_col).isNotNull()).toLocalIterator():
        n = r[1].count(" ") + 1
        if rows and size + n > BLOCK_WORDS:
            yield Items(rows, max_edits)
            rows, size = [], 0
        rows.append((r[0], r[1].encode()))
        size += n
    if rows:
        yield Items(rows, max_edits)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", max_edits: float = MAX_EDITS) -> DataFrame:
    """One row per contaminated (document, item): both ids, ``distance``, ``n_item_words`` and the word range of the passage."""
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    item_type = benchmark.schema[item_col].dataType
    out = T.StructType([T.StructField(id_col, src.schema["_id"].dataType), T.StructField(item_col, item_type)]
                       + [T.StructField(n, T.LongType()) for n in ("distance", "n_item_words", "first_word", "end_word")])
    result = None
    for items in item_blocks(benchmark, item_col, max_edits=max_edits):
        part = _matches(src, items, out)
        if result is not None:  # more than one block: each is a written table
            result = result.unionByName(materialize(part, "benchmark-matches"))
        else:
            result = part
    return src.sparkSession.createDataFrame([], out) if result is None else result


def _matches(src: DataFrame, items: Items, out: T.StructType) -> DataFrame:
    item_type = to_arrow_type(out.fields[1].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "_text"):
                found = items.matches(data, off)
                if found:
                    ids = part.column(0).take(pa.array([x[0] for x in found]))
                    of = pa.array([items.ids[x[1]] for x in found], type=item_type)
                    cols = [pa.array(c, type=pa.int64()) for c in zip(*((x[2], int(items.n[x[1]]), x[3], x[4]) for x in found))]
                    yield pa.RecordBatch.from_arrays([ids, of, *cols], names=out.names)

    return src.mapInArrow(run, out)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                    max_edits: float = MAX_EDITS) -> DataFrame:
    """The documents, with all their columns, that no benchmark item contaminates."""
    for items in item_blocks(benchmark, item_col, max_edits=max_edits):
        docs = docs.mapInArrow(_keeper(items, text_col), docs.schema)
    return docs


def _keeper(items: Items, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, text_col):
                keep = np.ones(len(part), dtype=bool)
                keep[[x[0] for x in items.matches(data, off)]] = False
                yield part.filter(pa.array(keep))

    return run
