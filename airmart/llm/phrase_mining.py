"""Phrase collocation mining over ordered count streams.

Counting: each task counts the phrases of its slices, and the counts of a phrase are summed map-side, then by phrase.
A phrase of ``MIN_COUNT`` occurrences has no part with fewer, so words and pairs are counted first, and longer phrases
only where all their pairs are frequent. Tasks know the frequent pairs by a bit map of ``FILTER_BITS`` bits; it lets some
others through (they fall to their counts), and loses none.

Joining: the frequent phrases form two streams, one ordered by their words (prefix order), one by their words from
the last to the first (suffix order). In prefix order a phrase follows its first parts and is followed by its extensions
to the right, so one pass that keeps the last row of each length attaches the counts of all first parts and the
largest right extension; the suffix stream does the same for last parts and left extensions. Then the two streams are
merged phrase by phrase. A phrase that any longer candidate makes superfluous is one that an extension by one
word does, as counts never rise with length.

Scale: streams are range-partitioned by language and the first two words of their order (the counts of single words are
joined to them before), sorted by Spark and read as a stream that holds one row of each length. Only the ranks of a
language see its candidates together, and Spark cuts these to ``TOP`` within each task first.

Edge cases: a null or empty text, or one without words, counts nothing; a null language is ``und``. Repeated rows and
rows without ids count like any others. Arithmetic is in whole numbers that do not pass their types (decimals where a
product could). Other columns are not read. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._tables import materialize, schema, width
from ._words import _BYTE, _LOWER, _powers, mix, slices

MIN_COUNT, LONGEST, TOP = 30, 4, 2000
SHARE = 80               # per cent of a phrase's occurrences that make a longer one replace it
SCALE = 2_000_000
FILTER_BITS = 1 << 26    # 8 MB, whatever the input's size
_U = np.uint64
_END = np.zeros(256, dtype=bool)
_END[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _END.copy()
_GAP[[0x20, 0x09]] = True


class Pieces:
    """Words of a slice of texts: numbers of equal words (``word``), the distinct ones (``names``), a hash of each word, and for
    each place how many words follow within its piece (``left``, itself included) and its ``row``."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        n, data = len(data), _LOWER[data]
        word = np.ones(n + 1, dtype=bool)
        word[n] = False
        word[:n] = ~_GAP[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[off] = True
        start = word.copy()
        start[1:] &= ~word[:-1] | edge[1:]
        start, end = np.flatnonzero(start), np.flatnonzero(word[:n] & (~word[1:] | edge[1:])) + 1
        self.row = np.searchsorted(off, start, side="right") - 1
        p, q = _powers(n + 1)
        hashes = []
        for seed, byte in ((61, _BYTE), (62, mix(_BYTE, 63))):
            total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(byte[data] * p[:n], out=total[1:])
            hashes.append(mix((total[end] - total[start]) * q[start] + (end - start).astype(np.uint64), seed))
        self.hash = hashes[0]
        kinds, at, self.word = np.unique(self.hash, return_index=True, return_inverse=True)
        if (hashes[1][at][self.word] != hashes[1]).any():  # two words of one hash: numbered by both
            _, at, self.word = np.unique(np.stack(hashes), axis=1, return_index=True, return_inverse=True)
        size = end[at] - start[at]
        offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
        chars = data[np.repeat(start[at] - offsets[:-1], size) + np.arange(offsets[-1])]
        self.names = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(chars.tobytes()))
        stops = np.concatenate(([0], np.cumsum(_END[data])))[start] if n else start
        new = np.ones(len(start), dtype=bool)
        new[1:] = (self.row[1:] != self.row[:-1]) | (stops[1:] != stops[:-1])
        first = np.flatnonzero(new)
        run = np.diff(np.concatenate((first, [len(start)])))
        self.left = np.repeat(first + run, run) - np.arange(len(start))


def _pair_bit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The bit of a pair of words, by their hashes."""
    return mix(a ^ mix(b, 64), 65) % _U(FILTER_BITS)


def _counted(p: Pieces, lang: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(language number, word numbers, occurrences) of the distinct phrases of a length that begin at the places."""
    n = len(p.names)
    key, kinds = lang[p.row[places]].astype(np.int64), []
    for j in range(length):  # numbered step by step, so keys stay below (distinct phrases) * (distinct words)
        both = key * n + p.word[places + j]
        kind, key = np.unique(both, return_inverse=True)
        kinds.append(kind)
    count = np.bincount(key, minlength=len(kinds[-1]))
    words, at = [], kinds[-1]
    for j in range(length - 1, -1, -1):
        words.append(at % n)
        at = kinds[j - 1][at // n] if j else at // n
    return at, words[::-1], count


def _phrases(p: Pieces, words: list[np.ndarray]) -> pa.Array:
    parts = [p.names.take(pa.array(w)) for w in words]
    return pa.compute.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]


def phrase_counts(docs: DataFrame, lengths: tuple[int, ...], lang_col: str = "lang", text_col: str = "text", frequent=None) -> DataFrame:
    """``lang, phrase, f``: occurrences of all phrases of the lengths; with ``frequent`` (a broadcast bit map of pairs) only of those
    whose pairs are in it. The phrase '' counts a language's words."""
    out = schema("lang string, phrase string, f long")
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "text"):
                kinds = pa.compute.dictionary_encode(part.column(0))
                lang, p = np.asarray(kinds.indices), Pieces(data, off)
                if not len(p.word):
                    continue
                left = p.left
                if frequent is not None:  # a place leads as far as its pairs are frequent
                    bit = _pair_bit(p.hash[:-1], p.hash[1:])
                    known = np.frombuffer(frequent.value, dtype=np.uint8)[bit >> _U(3)] >> (bit & _U(7)).astype(np.uint8) & 1
                    go = np.concatenate((known.astype(bool), [False])) & (left > 1)
                    stop = np.where(go, len(go), np.arange(len(go)))
                    left = np.minimum.accumulate(stop[::-1])[::-1] - np.arange(len(go)) + 1
                elif 1 in lengths:
                    n = np.bincount(lang[p.row], minlength=len(kinds.dictionary))
                    yield pa.RecordBatch.from_arrays([kinds.dictionary, pa.array([""] * len(n)), pa.array(n)], names=out.names)
                for length in lengths:
                    places = np.flatnonzero(left >= length)
                    if len(places):
                        at, words, count = _counted(p, lang, places, length)
                        yield pa.RecordBatch.from_arrays([kinds.dictionary.take(pa.array(at)), _phrases(p, words), pa.array(count)], names=out.names)

    return src.mapInArrow(run, out).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def pair_filter(pairs: DataFrame) -> bytes:
    """The bit map of frequent pairs (of ``phrase``): FILTER_BITS / 8 bytes, put together from segments."""
    segment = 1 << 18  # bits
    place = schema("segment long, bit long")

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "phrase"):
                p = Pieces(data, off)
                at = _pair_bit(p.hash[0::2], p.hash[1::2]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at // segment), pa.array(at % segment)], names=place.names)

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            number, bit = (np.asarray(batch.column(i)) for i in (0, 1))
            for k in np.unique(number):
                held.setdefault(int(k), np.zeros(segment, dtype=bool))[bit[number == k]] = True
        for k, x in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([np.packbits(x, bitorder="little").tobytes()], type=pa.binary())], names=["segment", "map"])

    parts = pairs.select("phrase").mapInArrow(bits, place).distinct().repartition(width(pairs.sparkSession), "segment").mapInArrow(maps, schema("segment long, map binary"))
    out = bytearray(FILTER_BITS // 8)
    for row in parts.collect():  # FILTER_BITS / segment rows at most
        out[row["segment"] * segment // 8:(row["segment"] + 1) * segment // 8] = row["map"]
    return bytes(out)


def frequent_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, f`` of the frequent phrases of up to LONGEST words, and ``lang, n`` (words of each language)."""
    spark = docs.sparkSession
    short = materialize(phrase_counts(docs, (1, 2), lang_col, text_col).where((F.col("f") >= min_count) | (F.col("phrase") == "")), "phrases-short")
    pairs = short.where(F.instr("phrase", " ") > 0)
    known = spark.sparkContext.broadcast(pair_filter(pairs))
    long = materialize(phrase_counts(docs, tuple(range(3, LONGEST + 1)), lang_col, text_col, known).where(F.col("f") >= min_count), "phrases-long")
    known.unpersist()
    return short.where("phrase <> ''").unionByName(long), short.where("phrase = ''").select("lang", F.col("f").alias("n"))


def _walk(rows: DataFrame) -> DataFrame:
    """Phrases in the order of their words, with ``one`` (the count of the first word) -> ``parts`` (the counts of the first 1, 2, ... words)
    and ``ext`` (the largest count of a phrase that goes on with one word more, else 0)."""
    out = schema("lang string, phrase string, f long, parts longs, ext long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: list[list] = []  # of the last phrase and its first parts: [lang, words, phrase, f, parts, ext]
        for batch in batches:
            done = []
            for lang, words, phrase, f, one in zip(*(batch.column(i).to_pylist() for i in range(5))):
                while open_rows and (open_rows[-1][0] != lang or open_rows[-1][1] != words[:len(open_rows[-1][1])]):
                    done.append(open_rows.pop())
                if open_rows:
                    open_rows[-1][5] = max(open_rows[-1][5], f)
                parts = open_rows[-1][4] + [open_rows[-1][3]] if open_rows else [one]
                open_rows.append([lang, words, phrase, f, parts, 0])
            if done:
                yield _batch(done)
        if open_rows:
            yield _batch(open_rows)

    def _batch(done: list[list]) -> pa.RecordBatch:
        cols = list(zip(*done))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], type=pa.string()), pa.array(cols[2], type=pa.string()), pa.array(cols[3], type=pa.int64()),
                                           pa.array(cols[4], type=pa.list_(pa.int64())), pa.array(cols[5], type=pa.int64())], names=out.names)

    return rows.mapInArrow(run, out)


def _stream(counts: DataFrame, backwards: bool) -> DataFrame:
    """The stream of phrases of two words or more in prefix or suffix order, walked."""
    words = F.split("phrase", " ", -1)
    words = F.reverse(words) if backwards else words
    single = counts.where(F.instr("phrase", " ") == 0).select("lang", F.col("phrase").alias("w1"), F.col("f").alias("one"))
    rows = counts.where(F.instr("phrase", " ") > 0).withColumn("words", words).withColumns({"w1": F.col("words")[0], "w2": F.col("words")[1]})
    rows = rows.hint("merge").join(single, ["lang", "w1"])
    rows = rows.repartitionByRange(width(counts.sparkSession), "lang", "w1", "w2").sortWithinPartitions("lang", "words")
    return _walk(rows.select("lang", "words", "phrase", "f", "one"))


def scored_phrases(counts: DataFrame) -> DataFrame:
    """Candidates that no longer one replaces: ``lang, phrase, a, l, r, score`` by their lowest-scoring cut."""
    ahead = _stream(counts, False).select("lang", "phrase", F.col("f").alias("a"), F.col("parts").alias("firsts"), F.col("ext").alias("right"))
    back = _stream(counts, True).select("lang", "phrase", F.reverse("parts").alias("lasts"), F.col("ext").alias("left"))
    both = ahead.hint("merge").join(back, ["lang", "phrase"])
    # The first k words have count firsts[k - 1], the rest lasts[k - 1]: cuts in order of k, the smallest (score, k) counts.
    score = f"CAST((CAST(a AS DECIMAL(20,0)) * {SCALE}) div (CAST(x AS DECIMAL(20,0)) + CAST(lasts[i] AS DECIMAL(20,0))) AS BIGINT)"
    cut = f"array_min(transform(firsts, (x, i) -> struct({score} AS score, i AS k, x AS l, lasts[i] AS r)))"
    stays = f"CAST(greatest(`left`, `right`) AS DECIMAL(20,0)) * 100 < CAST(a AS DECIMAL(20,0)) * {SHARE}"
    return both.where(stays).withColumn("cut", F.expr(cut)).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def ranked_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``."""
    counts, total = frequent_counts(docs, lang_col, text_col, min_count)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = scored_phrases(counts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
