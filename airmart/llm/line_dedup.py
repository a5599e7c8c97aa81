"""Line dedup by content-defined line chunks.

Lines are hashed; a rolling hash over the hashes of two neighbouring lines chooses chunk borders (one line in
``SPREAD`` on average, at least ``MIN_LINES`` lines a chunk), so inserted or removed lines move only the
borders next to them. A chunk that occurred before in the corpus (by id, then position) is removed. Chunks that
share a 128-bit hash are compared byte by byte: occurrences are grouped by their bytes, and only equal bytes
count as repeats.

With ``runs`` (the registered query) the units are all pairs of neighbouring lines instead, so every repeated run of
two lines or more goes, wherever chunk borders would lie. The first occurrence of a line always stays: a pair repeats
one of its own text only where the two do not overlap.

Scale: narrow rows (hash, id, place) are combined on the map side; joins on a hot chunk split between tasks;
the bytes of repeated chunks are combined on the map side before they are dealt out, so a chunk that a third of
all documents share arrives once per map task. The lists of chunks grow with the input, so they meet the texts by
a merge join at every size.

Edge cases: a null or empty text, and a text of one line, has no multi-line chunk and stays as it is (a null
stays null). A tail of one line belongs to the chunk before it. Chunks without a word are never removed. Null
ids order after all others; rows that are equal in id and text are ordered by nothing, so of equal rows all
keep what the first of them keeps. Other columns pass through whatever their names. An empty table stays empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._tables import materialize, order_id, own_id, schema
from ._words import _BYTE, _powers, _SPACE, mix, slices

SPREAD = 4       # one border in so many lines, on average
MIN_LINES = 2
_U = np.uint64
# A text is its id with 95 bits of two hashes of it: ``mark`` (64) and the upper part of a place (31, then the number of the
# chunk), so rows that share an id, or have none, stay apart.
_PLACE_BITS = 32
TEXT = ["id", "mark", "tail"]


def _marks() -> list[Column]:
    return [F.xxhash64("text").alias("mark"), F.hash("text").bitwiseAND(F.lit((1 << (_PLACE_BITS - 1)) - 1)).cast("long").alias("tail")]


def _by_text(places: DataFrame) -> DataFrame:
    """Places of each text, as one array (bounded by the text's length)."""
    return places.groupBy("id", "mark", F.shiftrightunsigned("place", _PLACE_BITS).alias("tail")).agg(F.collect_list("place").alias("places"))


class Lines:
    """Lines of a slice of texts: byte ``start``/``end``, ``row`` and two hashes; ``first`` line of each row."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        n = len(data)
        cut = np.flatnonzero(data == 10)
        self.start = np.sort(np.concatenate((off[:-1], cut + 1)), kind="stable")
        self.end = np.sort(np.concatenate((off[1:], cut)), kind="stable")
        self.row = np.repeat(np.arange(len(off) - 1), 1 + np.bincount(np.searchsorted(off, cut, side="right") - 1, minlength=len(off) - 1))
        self.first = np.searchsorted(self.row, np.arange(len(off)))
        p, q = _powers(n + 1)
        self.hash = []
        for seed, byte in ((41, _BYTE), (42, mix(_BYTE, 43))):
            total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(byte[data] * p[:n], out=total[1:])
            self.hash.append(mix((total[self.end] - total[self.start]) * q[self.start] + (self.end - self.start).astype(np.uint64), seed))
        word = np.concatenate(([0], np.cumsum(~_SPACE[data])))
        self.has_word = word[self.end] > word[self.start]


def chunks(lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """(first line, end line) of the chunks of a slice."""
    n = len(lines.row)
    h = lines.hash[0]
    roll = mix(h + mix(np.concatenate(([_U(0)], h[:-1])), 44), 45)
    border = roll % _U(SPREAD) == 0          # the chunk ends after this line
    first, last = lines.first[lines.row], lines.first[lines.row + 1] - 1
    border[np.arange(n) == first] = False    # its neighbour is another text
    ends = []
    open_at = -1
    for i in np.flatnonzero(border | (np.arange(n) == last)):
        begin = max(open_at + 1, int(first[i]))
        if i == last[i] or (i + 1 - begin >= MIN_LINES and last[i] - i >= MIN_LINES):
            ends.append(i + 1)
            open_at = i
    end = np.array(ends, dtype=np.int64)
    return np.concatenate(([0], end[:-1])).astype(np.int64)[:len(end)], end


def pairs(lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """(first line, end line) of all pairs of neighbouring lines of a slice."""
    a = np.flatnonzero(lines.row[1:] == lines.row[:-1])
    return a, a + 2


def _pair_hashes(lines: Lines, a: np.ndarray) -> list[np.ndarray]:
    return [mix(mix(h[a], 47) + mix(h[a + 1] + _U(1), 46), 48) for h in lines.hash]


def _units(lines: Lines, runs: bool) -> tuple[np.ndarray, np.ndarray]:
    return pairs(lines) if runs else chunks(lines)


def _unit_hashes(lines: Lines, a: np.ndarray, b: np.ndarray, runs: bool) -> list[np.ndarray]:
    return _pair_hashes(lines, a) if runs else _chunk_hashes(lines, a, b)


def _chunk_hashes(lines: Lines, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    out = []
    for h in lines.hash:
        pos = np.arange(len(h)) - np.repeat(a, b - a)
        out.append(mix(np.add.reduceat(mix(h + mix(pos.astype(np.uint64), 46), 47), a) + (b - a).astype(np.uint64), 48) if len(a) else np.zeros(0, np.uint64))
    return out


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(order_id(id_col).alias("id"), text.alias("text")).select("id", *_marks(), "text")


def chunk_rows(src: DataFrame, runs: bool = False) -> DataFrame:
    """``h1, h2, id, mark, place`` of the chunks of two lines or more that hold a word; place: rest of the text's mark, chunk number."""
    out = schema("h1 long, h2 long, id long, mark long, place long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "text"):
                lines = Lines(data, off)
                a, b = _units(lines, runs)
                h1, h2 = _unit_hashes(lines, a, b, runs)
                row = lines.row[a]
                number = np.arange(len(a)) - np.searchsorted(a, lines.first[row])
                total = np.concatenate(([0], np.cumsum(lines.has_word)))
                words = total[b] - total[a]
                ok = (b - a >= MIN_LINES) & (words > 0)
                ids, mark, tail = (np.asarray(part.column(i))[row] for i in range(3))
                place = (tail << _PLACE_BITS) | number
                yield pa.RecordBatch.from_arrays([pa.array(x[ok]) for x in (h1.view(np.int64), h2.view(np.int64), ids, mark, place)], names=out.names)

    return src.mapInArrow(run, out)


def _chunk_bytes(src: DataFrame, wanted: DataFrame, runs: bool) -> DataFrame:
    """``h1, h2, id, mark, place, bytes`` of the wanted chunks (of ``id, mark, place``)."""
    out = schema("h1 long, h2 long, id long, mark long, place long, bytes binary")
    rows = src.join(_by_text(wanted).hint("merge"), TEXT).select(*TEXT, "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "text"):
                lines = Lines(data, off)
                a, b = _units(lines, runs)
                h1, h2 = (x.view(np.int64) for x in _unit_hashes(lines, a, b, runs))
                begin = np.searchsorted(a, lines.first[:-1])
                cols: list[list] = [[] for _ in out.names]
                for i, places in enumerate(part.column(4)):
                    for place in np.unique(np.asarray(places.values)):
                        c = begin[i] + (place & ((1 << _PLACE_BITS) - 1))
                        for col, value in zip(cols, (h1[c], h2[c], part.column(0)[i].as_py(), part.column(1)[i].as_py(), place, data[lines.start[a[c]]:lines.end[b[c] - 1]].tobytes())):
                            col.append(value)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, type=pa.int64()) for c in cols[:-1]), pa.array(cols[-1], type=pa.binary())], names=out.names)

    return rows.mapInArrow(run, out)


def repeated_chunks(src: DataFrame, runs: bool = False) -> DataFrame:
    """``id, mark, place`` of the chunks that occurred before, byte for byte."""
    place = ["id", "mark", "place"]
    rows = materialize(chunk_rows(src, runs), "line-chunks")
    key = ["h1", "h2"]
    again = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key)
    again = materialize(rows.join(again, key), "line-repeats")
    held = _chunk_bytes(src, again.select(*place), runs)
    kinds = materialize(held.groupBy(*key, "bytes").agg(F.min(F.struct(*place)).alias("first"), F.count(F.lit(1)).alias("n")), "line-bytes")
    differ = kinds.groupBy(*key).agg(F.count(F.lit(1)).alias("kinds"), F.min("first").alias("first"))
    later = (F.col("id") != F.col("first.id")) | (F.col("mark") != F.col("first.mark")) | (F.col("place") - F.col("first.place") >= (2 if runs else 1))
    out = again.join(differ.where("kinds = 1").select(*key, "first"), key).where(later).select(*place)
    clash = differ.where("kinds > 1").select(*key)
    if not clash.isEmpty():  # different bytes under one 128-bit hash: settled by the bytes themselves
        both = again.join(clash, key)
        out = out.unionByName(_chunk_bytes(src, both.select(*place), runs).join(kinds.select(*key, "bytes", "first"), [*key, "bytes"])
                              .where(later).select(*place))
    return materialize(out, "line-removals")


def _kept(src_rows: DataFrame, passed: list[str], out: T.StructType, text_out: bool, runs: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "text"):
                lines = Lines(data, off)
                a, b = _units(lines, runs)
                begin = np.searchsorted(a, lines.first[:-1])
                total, gone, kept = [], [], []
                raw = data.tobytes()
                for i, places in enumerate(part.column("places")):
                    lo, hi = int(lines.first[i]), int(lines.first[i + 1])
                    total.append(hi - lo)
                    if places.is_valid:
                        c = begin[i] + (np.unique(np.asarray(places.values)) & ((1 << _PLACE_BITS) - 1))
                        drop = np.zeros(hi - lo, dtype=bool)
                        for x, y in zip(a[c] - lo, b[c] - lo):
                            drop[x:y] = True
                        gone.append(int(drop.sum()))
                        kept.append(b"\n".join(raw[lines.start[lo + j]:lines.end[lo + j]] for j in np.flatnonzero(~drop)))
                    else:
                        gone.append(0)
                        kept.append(raw[off[i]:off[i + 1]])
                text = pa.array([t.decode() for t in kept], type=pa.string()) if text_out else pa.array([hashlib.sha256(t).hexdigest() for t in kept])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in passed), pa.array(total), pa.array(gone), text], names=out.names)

    return src_rows.mapInArrow(run, out)


def _with_places(src: DataFrame, extra: list[str], runs: bool) -> DataFrame:
    gone = repeated_chunks(src.select(*TEXT, "text"), runs)
    return src.join(_by_text(gone).hint("merge"), TEXT, "left").select("id", "text", "places", *extra)


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: bool = False) -> DataFrame:
    """One row per document: id, ``n_lines``, ``n_removed_lines`` and ``kept_sha256`` (of the kept lines)."""
    out = schema("id long, n_lines long, n_removed_lines long, kept_sha256 string")
    rows = _kept(_with_places(_source(docs, id_col, text_col), [], runs), ["id"], out, False, runs)
    return rows.select(own_id("id").alias(id_col), "n_lines", "n_removed_lines", "kept_sha256")


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", runs: bool = False) -> DataFrame:
    """The documents with all their columns, repeated chunks gone from the text and ``chars_col`` brought up to date.
    Documents of which no word is left are dropped; documents that lost nothing stay as they are."""
    src = docs.select(order_id(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                      F.struct(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("own"), F.col(text_col).isNull().alias("null")).alias("rest"))
    src = src.select("id", *_marks(), "text", "rest")
    out = T.StructType([T.StructField("rest", src.schema["rest"].dataType), *schema("n_lines long, gone long, kept string").fields])
    rows = _kept(_with_places(src, ["rest"], runs), ["rest"], out, True, runs)
    rows = rows.where((F.col("gone") == 0) | F.col("kept").rlike("[^\\x20\\x09-\\x0D]"))
    text = F.when(~F.col("rest.null"), F.col("kept"))
    pick = {text_col: text}
    if chars_col in docs.columns:
        pick[chars_col] = F.when(F.col("gone") > 0, F.length("kept")).otherwise(F.col(f"rest.own.`{chars_col}`")).cast(docs.schema[chars_col].dataType)
    return rows.select(*(pick.get(c, F.col(f"rest.own.`{c}`")).alias(c) for c in docs.columns))
