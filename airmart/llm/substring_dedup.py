"""Substring dedup by relative Lempel-Ziv parsing against content-defined reference blocks.

Every text is cut into blocks at content-defined anchors: each window of ``WINDOW`` words has the five-word
gram of smallest hash as its anchor, and a block is the run of windows that share one anchor occurrence. All
blocks of the corpus are the reference, indexed by anchor and content. A document is parsed left to right
against it: a block that an earlier document (smaller id) holds whole is copied. A copied passage starts and
ends within a block, so blocks whose anchor occurs with other contents too - the factor boundaries - are
checked window by window. Adjacent copied windows join into factors; a factor has ``WINDOW`` words or more, and
its words are removed.

The result is exact up to 128-bit content hashes: a word goes if and only if it lies in a window of ``WINDOW``
words that also occurs in a document with a smaller id, both taken from the input.

Scale: one narrow row per distinct block of a text (about one for five words) is dealt out by anchor and sorted;
a task streams over the sorted rows and holds the open rows of one document. Blocks that a text repeats are one
row with all their places, so a text that repeats itself a million times is no hot key. A passage that a third
of all documents share adds one row per document to each of its anchors' partitions. Texts are dealt out by id,
twice.

Edge cases: a null or empty text has no words and the SHA-256 of the empty string. A null id is larger than
all others; rows with equal ids do not remove each other's words, whether their texts are equal or not. Other
columns are not read. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import materialize, order_id, own_id, schema, width
from ._words import Words, grams, mix, slices

WINDOW = 13
GRAM = 5
_U = np.uint64
_Q = 0x9E6C63D0876A9A47 | 1
_QINV = pow(_Q, -1, 1 << 64)
# A text is its id with 95 bits of two hashes of it: ``mark`` (64) and the upper part of a place (31, then first window,
# windows - 1), so rows that share an id, or have none, stay apart.
_PLACE_BITS, _RUN_BITS = 32, 4
TEXT = ["id", "mark", "tail"]


def _word_prefix(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers, from which the hash of any run of words follows."""
    n = len(h)
    p, q = np.full(n + 1, _Q, dtype=np.uint64), np.full(n + 1, _QINV, dtype=np.uint64)
    p[0] = q[0] = 1
    p, q = np.multiply.accumulate(p), np.multiply.accumulate(q)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mix(h, 21) * p[:n], out=total[1:])
    return total, q


def blocks(w: Words, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, anchor, content, first window, windows) of the blocks of a slice; windows are counted in the slice's words."""
    n_win = len(h) - WINDOW + 1
    if n_win <= 0:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
    g = grams(h, GRAM)
    rank = mix(g, 22)
    best, at = rank[:n_win].copy(), np.arange(n_win)
    for j in range(1, WINDOW - GRAM + 1):
        other = rank[j:j + n_win]
        less = other < best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + j
    live = np.flatnonzero(w.rows_left()[:n_win] >= WINDOW)
    if not len(live):
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
    doc, at = w.doc[live], at[live]
    new = np.ones(len(live), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    run = np.diff(np.concatenate((first, [len(live)])))
    lo = live[first]
    total, q = _word_prefix(h)
    content = mix((total[lo + run + WINDOW - 1] - total[lo]) * q[lo] + (at[first] - lo).astype(np.uint64) * _U(31) + run.astype(np.uint64), 23)
    return doc[first], g[at[first]], content, lo, run


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    tail = F.hash("text").bitwiseAND(F.lit((1 << (_PLACE_BITS - 1)) - 1)).cast("long")
    return docs.select(order_id(id_col).alias("id"), text.alias("text")).select("id", F.xxhash64("text").alias("mark"), tail.alias("tail"), "text")


def _places(tail: np.ndarray, window: np.ndarray, run: np.ndarray) -> np.ndarray:
    return (tail.astype(np.int64) << _PLACE_BITS) | (window << _RUN_BITS) | (run - 1)


def _keyed(k1: np.ndarray, k2: np.ndarray, row: np.ndarray, ids: np.ndarray, mark: np.ndarray, place: np.ndarray) -> list[pa.Array]:
    """One entry for each distinct (row, k1, k2): keys, id and mark, first place, and the other places packed (mostly null)."""
    order = np.lexsort((place, k2, k1, row))
    k1, k2, row, place = k1[order], k2[order], row[order], place[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.concatenate((first, [len(row)])))
    more: list = [None] * len(first)
    for i in np.flatnonzero(size > 1):
        more[i] = place[first[i] + 1:first[i] + size[i]].tobytes()
    return [pa.array(k1[first].view(np.int64)), pa.array(k2[first].view(np.int64)), pa.array(ids[row[first]]), pa.array(mark[row[first]]),
            pa.array(place[first]), pa.array(more, type=pa.binary())]


def _unpacked(pick: np.ndarray, ids: np.ndarray, mark: np.ndarray, place: np.ndarray, more: pa.Array) -> tuple[np.ndarray, ...]:
    """(entry, id, mark, place) of every place of the picked entries."""
    at = np.flatnonzero(pick)
    again = at[np.asarray(more.is_valid())[at]] if more.null_count < len(more) else at[:0]
    lists = [np.frombuffer(more[int(i)].as_py(), dtype=np.int64) for i in again]
    entry = np.concatenate([at, *(np.full(len(x), i) for i, x in zip(again, lists))]).astype(np.int64)
    return entry, ids[entry], mark[entry], np.concatenate([place[at], *lists])


def _block_rows(src: DataFrame) -> DataFrame:
    out = schema("anchor long, content long, id long, mark long, place long, more binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "text"):
                w = Words(data, off)
                row, anchor, content, lo, n = blocks(w, w.hashes())
                ids, mark, tail = (np.asarray(part.column(i)) for i in range(3))
                yield pa.RecordBatch.from_arrays(_keyed(anchor, content, row, ids, mark, _places(tail[row], lo - w.first[row], n)), names=out.names)

    return src.mapInArrow(run, out)


def _parse(rows: DataFrame) -> DataFrame:
    """Blocks ordered by (anchor, content, id) -> ``id, mark, place, copied``: blocks that an earlier document holds, and
    the first holders of blocks whose anchor has other contents too (open: to be checked by window)."""
    out = schema("id long, mark long, place long, copied boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor = content = least = None   # of the last row: its anchor, its content and that content's least id
        several = False                   # the last anchor has had two contents
        held: list[tuple[np.ndarray, ...]] = []  # open rows of the last anchor while it has one content
        for batch in batches:
            a, c, ids, mark, place = (np.asarray(batch.column(i)) for i in range(5))
            more, n = batch.column(5), len(a)
            if not n:
                continue
            new_a, new_c = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
            new_a[1:] = a[1:] != a[:-1]
            goes_on = anchor is not None and a[0] == anchor
            new_a[0] = not goes_on
            new_c[1:] = new_a[1:] | (c[1:] != c[:-1])
            new_c[0] = not (goes_on and c[0] == content)
            start = np.flatnonzero(new_c)
            group = np.cumsum(new_c) - 1
            low = np.concatenate(([least if least is not None else 0], ids[start]))[group + 1]
            copied = ids > low
            ag = np.cumsum(new_a) if goes_on else np.cumsum(new_a) - 1   # 0 is the anchor that goes on
            n_contents = np.bincount(ag[start], minlength=ag[-1] + 1)
            if goes_on:
                n_contents[0] += 2 if several else 1
            multi = n_contents > 1
            keep = copied | multi[ag]
            if held and (not goes_on or multi[0]):
                if goes_on:
                    for i, m, p in held:
                        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(m), pa.array(p), pa.array(np.zeros(len(i), dtype=bool))], names=out.names)
                held = []
            if not multi[-1]:
                wait = ~copied & (ag == ag[-1])
                if wait.any():
                    held.append(_unpacked(wait, ids, mark, place, more)[1:])
            if keep.any():
                entry, i, m, p = _unpacked(keep, ids, mark, place, more)
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(m), pa.array(p), pa.array(copied[entry])], names=out.names)
            anchor, content, least, several = a[-1], c[-1], low[-1], bool(multi[-1])

    return rows.mapInArrow(run, out)


def _by_text(places: DataFrame) -> DataFrame:
    """Places of each text, as one array (bounded by the text's length)."""
    return places.groupBy("id", "mark", F.shiftrightunsigned("place", _PLACE_BITS).alias("tail")).agg(F.collect_list("place").alias("places"))


def _windows(place: np.ndarray) -> np.ndarray:
    """The windows that places stand for."""
    low = place & ((1 << _PLACE_BITS) - 1)
    first, run = low >> _RUN_BITS, (low & ((1 << _RUN_BITS) - 1)) + 1
    return np.repeat(first - np.concatenate(([0], np.cumsum(run)[:-1])), run) + np.arange(run.sum())


def _open_windows(src: DataFrame, places: DataFrame) -> DataFrame:
    """``w1, w2, id, mark, place, more``: the windows of open blocks."""
    out = schema("w1 long, w2 long, id long, mark long, place long, more binary")
    rows = src.join(_by_text(places), TEXT).select(*TEXT, "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "text"):
                w = Words(data, off)
                h = w.hashes()
                total, q = _word_prefix(h)
                other, _ = _word_prefix(mix(h, 24))
                lists = part.column(4)
                per_row = [_windows(np.asarray(x.values)) for x in lists]
                row = np.repeat(np.arange(len(part)), [len(x) for x in per_row])
                local = np.concatenate(per_row) if per_row else np.zeros(0, dtype=np.int64)
                at = local + w.first[row]
                w1, w2 = (mix((t[at + WINDOW] - t[at]) * q[at], 25) for t in (total, other))
                ids, mark, tail = (np.asarray(part.column(i)) for i in range(3))
                yield pa.RecordBatch.from_arrays(_keyed(w1, w2, row, ids, mark, _places(tail[row], local, np.ones(len(local), dtype=np.int64))), names=out.names)

    return rows.mapInArrow(run, out)


def _repeats(rows: DataFrame) -> DataFrame:
    """Windows ordered by (w1, w2, id) -> the places of those that an earlier document holds."""
    out = schema("id long, mark long, place long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = least = None
        for batch in batches:
            a, b, ids, mark, place = (np.asarray(batch.column(i)) for i in range(5))
            if not len(a):
                continue
            new = np.ones(len(a), dtype=bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            new[0] = last != (a[0], b[0])
            low = np.concatenate(([least if least is not None else 0], ids[new]))[np.cumsum(new)]
            again = ids > low
            last, least = (a[-1], b[-1]), low[-1]
            if again.any():
                _, i, m, p = _unpacked(again, ids, mark, place, batch.column(5))
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(m), pa.array(p)], names=out.names)

    return rows.mapInArrow(run, out)


def copied_places(src: DataFrame) -> DataFrame:
    """``id, mark, place`` of all windows that an earlier document holds."""
    p = width(src.sparkSession)
    ordered = _block_rows(src).repartition(p, "anchor").sortWithinPartitions("anchor", "content", "id")
    parsed = materialize(_parse(ordered), "rlz-blocks")
    windows = _open_windows(src, parsed.where(~F.col("copied")).drop("copied"))
    edges = materialize(_repeats(windows.repartition(p, "w1").sortWithinPartitions("w1", "w2", "id")), "rlz-edges")
    return parsed.where("copied").drop("copied").unionByName(edges)


def remove_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_factors: bool = False) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed`` and ``kept_sha256`` (of the kept words joined by a space);
    with ``with_factors`` also ``text`` (the kept words) and ``factors`` (word starts and ends of removed passages)."""
    src = _source(docs, id_col, text_col)
    rows = src.join(_by_text(copied_places(src)), TEXT, "left").select("id", "text", "places")
    out = schema("id long, n_words long, n_removed long, kept_sha256 string" + (", text string, factors longs" if with_factors else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "text"):
                raw = data.tobytes()
                cols: list[list] = [[] for _ in out.names[1:]]
                for i, places in enumerate(part.column(2)):
                    words = raw[off[i]:off[i + 1]].split()
                    n = len(words)
                    factors: list[int] = []
                    if places.is_valid:
                        edge = np.zeros(n + 1, dtype=np.int64)
                        at = _windows(np.asarray(places.values))
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + WINDOW, -1)
                        gone = np.concatenate(([0], (np.cumsum(edge)[:n] > 0).view(np.int8), [0]))
                        turn = np.flatnonzero(np.diff(gone))
                        factors = turn.tolist()
                        kept, last = [], 0
                        for a, b in zip(factors[::2], factors[1::2]):
                            kept += words[last:a]
                            last = b
                        kept += words[last:]
                    else:
                        kept = words
                    text = b" ".join(kept)
                    for col, value in zip(cols, (n, n - len(kept), hashlib.sha256(text).hexdigest(), text.decode() if with_factors else None, factors)):
                        col.append(value)
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, type=t) for c, t in zip(cols, types))], names=out.names)

    return rows.mapInArrow(run, out).withColumn("id", own_id("id")).withColumnRenamed("id", id_col)
