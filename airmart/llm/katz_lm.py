"""Katz backoff language model: counts, Good-Turing discounts, normalised backoff weights, scoring.

Tokens are lower-cased words (A-Z) and one end per text. For a token ``w`` after ``h`` (a start before the first):

    P(w|h) = f(h) d(c(hw)) c(hw) / c(h)      if c(hw) > 0
           = alpha(h) P(w)                   otherwise
    P(w)   = f d(c(w)) c(w) / N              if c(w) > 0, else the rest, as one unknown word

``d`` are Katz's Good-Turing discounts for counts up to ``CUTOFF`` (1 above; where a count of counts is empty,
``(r - 1/2) / r``). ``f(h)`` is 1, or less where discounts leave under half an event for unseen words, and
``alpha(h)`` is the exact rest over the exact unigram mass of what is left, so each history sums to one.

Bigrams move twice, in packed blocks: a task gathers the bigrams of a batch of texts and sends each shard of
histories its part. First a shard counts its bigrams and asks the word table, dealt out by word, for the counts of
its distinct words. Then the blocks come with the texts that hold each bigram; with the answers and the counts of
counts a shard has every term of the recursion for its histories, and sends one partial sum per text back. Shards
grow in number with the tokens (``SHARD_TOKENS``), so a task's memory does not. A history of more than a quarter
of a shard's tokens is spread over all shards by its successors; there are fewer than four such a shard, and their
sums (one row each) are the only counts that pass through the driver, beside N, V and a few counts of counts.

Edge cases: a null or empty text is an end alone. A null id counts as the empty text for the held-out rule.
Repeated rows count and are scored each by itself. Without training texts all probabilities are 1 (score 0).
Other columns are not read. An empty table gives an empty one. The input should be a table: a re-run task must
read the rows in the same order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import materialize, order_id, own_id, schema, width
from ._words import Words, slices

CUTOFF = 5          # counts above are not discounted
FOLDS, HELD = 7, 2  # texts with crc32(id) mod FOLDS = HELD are held out
BATCH_TOKENS = 450_000
BATCH_TEXTS = 60_000  # a text's number in its batch takes 16 bits
SLICE_TEXTS = 10_000  # texts looked at together; a batch ends before another slice could pass BATCH_TEXTS
SHARD_TOKENS = 6_000_000
_U = np.uint64
END, START = _U(0x8B3A_71C5_5D2E_9F17), _U(0x1F62_9C4D_E0A7_35B9)


def shard(keys: np.ndarray, n: int) -> np.ndarray:
    """One of n equal ranges of keys, so keys in order are in order of their shards."""
    return (((keys >> _U(32)) * _U(n)) >> _U(32)).astype(np.int64)


def shard_sql(key: str, n: int) -> Column:
    return F.expr(f"cast(shiftrightunsigned(shiftrightunsigned({key}, 32) * {n}, 32) as int)")


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block, byte planes apart (the high bytes of small numbers compress to nothing)."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpack(block: bytes, *kinds: tuple[type, int]) -> list[np.ndarray]:
    """The arrays of a block, given their types and lengths."""
    raw = np.frombuffer(pa.decompress(block, sum(np.dtype(t).itemsize * n for t, n in kinds), codec="zstd", asbytes=True), dtype=np.uint8)
    out, at = [], 0
    for t, n in kinds:
        size = np.dtype(t).itemsize
        out.append(np.ascontiguousarray(raw[at:at + size * n].reshape(size, n).T).view(t).reshape(n))
        at += size * n
    return out


def steps(sorted_keys: np.ndarray) -> np.ndarray:
    """Differences of ascending keys, the first from 0 (cumsum gives the keys back)."""
    return np.diff(sorted_keys, prepend=_U(0))


def discounts(n: dict[int, int]) -> list[float]:
    """d[0..CUTOFF] from counts of counts n[1..CUTOFF + 1] (d[0] is not used)."""
    got = [n.get(r, 0) for r in range(CUTOFF + 2)]
    mu = (CUTOFF + 1) * got[CUTOFF + 1] / got[1] if got[1] else 1.0
    out = [0.0]
    for r in range(1, CUTOFF + 1):
        d = ((r + 1) * got[r + 1] / got[r] / r - mu) / (1 - mu) if got[r] and got[r + 1] and mu != 1 else -1.0
        out.append(d if 0 < d < 1 else (r - 0.5) / r)
    return out


class Unigrams:
    """P(w) as a function of the training count."""

    def __init__(self, total: int, types: int, counts: dict[int, int]):
        self.total, self.types = total, types
        self.d = discounts(counts)
        lost = sum(counts.get(r, 0) * r * (1 - self.d[r]) for r in range(1, CUTOFF + 1))
        seen = 1 - lost / total if total else 0.0
        most = 1 - 0.5 / (total + 1) if total else 0.0
        self.f = most / seen if seen > most else 1.0
        self.unknown = 1 - min(seen, most)

    def prob(self, c: np.ndarray) -> np.ndarray:
        c = np.asarray(c, dtype=np.int64)
        d = np.where(c <= CUTOFF, np.array(self.d)[np.minimum(c, CUTOFF)], 1.0)
        return np.where(c > 0, self.f * d * c / max(self.total, 1), self.unknown)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == HELD
    return docs.select(order_id(id_col).alias("id"), held.alias("held"), F.col(text_col).cast("string").alias("text"))


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Batches of texts as (ids, held, tokens, histories, text number of each token)."""
    parts: list[tuple[np.ndarray, ...]] = []
    tokens = texts = 0

    def flush():
        columns = [list(x) for x in zip(*parts)]
        parts.clear()
        for i, column in enumerate(columns):
            columns[i] = np.concatenate(column)
            del column
        ids, held, tok, hist, n = columns
        return ids, held, tok, hist, np.repeat(np.arange(len(n), dtype=np.uint16), n)

    for batch in batches:
        for part, data, off in (x for at in range(0, len(batch), SLICE_TEXTS) for x in slices(batch.slice(at, SLICE_TEXTS), "text")):
            w = Words(data, off, lower=True)
            h = w.hashes()
            parts.append((np.asarray(part.column(0)), np.asarray(part.column(1).to_numpy(zero_copy_only=False), dtype=bool),
                          np.insert(h, w.first[1:], END), np.insert(h, w.first[:-1], START), np.diff(w.first) + 1))
            tokens += len(parts[-1][2])
            texts += len(part)
            if tokens >= BATCH_TOKENS or texts > BATCH_TEXTS - SLICE_TEXTS:
                tokens = texts = 0
                yield flush()
    if parts:
        yield flush()


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where each run of equal entries (in all of the arrays) starts."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def among(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which entries are in the sorted array ``of``."""
    if not len(of):
        return np.zeros(len(x), dtype=bool)
    return of[np.minimum(np.searchsorted(of, x), len(of) - 1)] == x


def word_counts(src: DataFrame) -> DataFrame:
    """``w, c, a``: occurrences in the training texts and in all."""
    out = schema("w long, c long, a long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, tok, _, text in _tokens(batches):
            words, at = np.unique(tok, return_inverse=True)
            c = np.bincount(at[~held[text]], minlength=len(words))
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(c), pa.array(np.bincount(at, minlength=len(words)))], names=out.names)

    return src.mapInArrow(run, out).groupBy("w").agg(F.sum("c").alias("c"), F.sum("a").alias("a"))


def in_order(h: np.ndarray, w: np.ndarray, text: np.ndarray, bits: int = 23) -> list[np.ndarray]:
    """Tokens by number of history, number of word and text: as one number each, if the first two take ``bits`` at most
    (a single text of millions of different words can have more)."""
    if not len(h) or max(h.max(), w.max()) >> bits == 0:
        key = np.sort((h << (bits + 16)) | (w << 16) | text)
        return [key >> (bits + 16), (key >> 16) & ((1 << bits) - 1), (key & 0xFFFF).astype(np.uint16)]
    order = np.lexsort((text, w, h))
    return [h[order], w[order], text[order]]


def bigram_blocks(src: DataFrame, n_shards: int, hot: np.ndarray, texts: bool) -> DataFrame:
    """Per batch of texts and shard of histories a block: histories, successors, training counts and, with ``texts``, the
    texts (their numbers in the batch) that hold each bigram with its occurrences there. A row of each batch without a
    block then lists its texts. Successors of ``hot`` histories (sorted) are dealt out by themselves."""
    out = schema("pid int, batch long, size int, nh int, nw int, nt int, block binary, ids binary, held binary, tokens binary")
    types = (pa.int32(), pa.int64(), *[pa.int32()] * 4, *[pa.binary()] * 4)

    def blocks(pid, hist, tok, c, n, text, times, batch, size):
        """Rows of bigrams ordered by shard and history."""
        cut, ends = np.searchsorted(pid, np.arange(n_shards + 1)), np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
        for p in np.flatnonzero(np.diff(cut)):
            a, b = cut[p], cut[p + 1]
            x, y = ends[a], ends[b]
            start = _runs(hist[a:b])
            arrays = [steps(hist[a:b][start]), np.diff(start, append=b - a).astype(np.uint32), tok[a:b], c[a:b]]
            if texts:
                arrays += [n[a:b], text[x:y], times[x:y]]
            yield (int(p), batch, size, len(start), int(b - a), int(y - x) if texts else 0, pack(*arrays), None, None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, (ids, held, tok, hist, text) in enumerate(_tokens(batches)):
            batch, size = (task << 32) | number, len(ids)
            rows = [(batch % n_shards, batch, size, 0, 0, 0, b"", ids.astype(np.int64).tobytes(), held.tobytes(),
                     np.bincount(text, minlength=size).astype(np.int64).tobytes())] if texts else []
            words, w = np.unique(tok, return_inverse=True)
            befores, h = np.unique(hist, return_inverse=True)
            del tok, hist
            h, w, text = in_order(h, w, text)
            at = _runs(h, w, text)
            times = np.diff(at, append=len(w)).astype(np.uint32)
            h, w, text = h[at], w[at], text[at]
            first = _runs(h, w)
            n = np.diff(first, append=len(w)).astype(np.uint16)
            c = np.add.reduceat(np.where(held[text], 0, times).astype(np.uint32), first, dtype=np.uint32) if len(first) else np.zeros(0, np.uint32)
            hist, tok = befores[h[first]], words[w[first]]
            spread = among(befores, hot)[h[first]]
            pid = shard(np.where(spread, tok ^ hist, hist), n_shards)
            if spread.any():
                of = np.repeat(spread, n)
                order = np.argsort(pid[spread], kind="stable")
                begin = (np.cumsum(n[spread], dtype=np.int64) - n[spread])[order]
                m = n[spread][order]
                moved = np.repeat(begin - (np.cumsum(m, dtype=np.int64) - m), m) + np.arange(m.sum(dtype=np.int64))
                rows += blocks(*(x[spread][order] for x in (pid, hist, tok, c, n)), text[of][moved], times[of][moved], batch, size)
                pid, hist, tok, c, n, text, times = *(x[~spread] for x in (pid, hist, tok, c, n)), text[~of], times[~of]
            rows += blocks(pid, hist, tok, c, n, text, times, batch, size)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(zip(*rows), types)], names=out.names)

    return src.mapInArrow(run, out)


class Shard(NamedTuple):
    """Distinct bigrams of a shard, in order, with their training counts (0: only in texts held out)."""
    h: np.ndarray      # histories
    w: np.ndarray      # places of the successors in ``words``
    c: np.ndarray
    words: np.ndarray  # distinct, in order
    blocks: list[tuple[np.ndarray, ...]]  # of each row: its bigrams' places here, and texts a bigram, texts, occurrences


def open_shard(rows: pa.Table, texts: bool) -> Shard:
    hs, ws, cs, rest = [], [], [], []
    kinds = lambda nh, nw, nt: ((_U, nh), (np.uint32, nh), (_U, nw), (np.uint32, nw), *(((np.uint16, nw), (np.uint16, nt), (np.uint32, nt)) if texts else ()))
    for nh, nw, nt, block in zip(*((x.as_py() for x in rows.column(c)) for c in ("nh", "nw", "nt", "block"))):  # one block at a time
        if not nw:
            rest.append((0, *(np.zeros(0, t) for t in (np.uint16, np.uint16, np.uint32))))
            continue
        h, many, w, c, *lists = unpack(block, *kinds(nh, nw, nt))
        hs.append(np.repeat(np.cumsum(h, dtype=_U), many))
        ws.append(w)
        cs.append(c)
        rest.append((nw, *lists))
    h, w, c = (np.concatenate([*x, np.zeros(0, t)]).astype(t, copy=False) for x, t in ((hs, _U), (ws, _U), (cs, np.uint32)))
    hs.clear(), ws.clear(), cs.clear()
    words, w = np.unique(w, return_inverse=True)
    befores, h = np.unique(h, return_inverse=True)
    order = np.argsort(h * len(words) + w)
    h, w = h[order], w[order]
    first = _runs(h, w)
    place = np.empty(len(h), dtype=np.int32)
    place[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(first, append=len(h)))
    c = np.add.reduceat(c[order], first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    ends = np.cumsum([r[0] for r in rest])
    return Shard(befores[h[first]], w[first], c, words, [(place[b - r[0]:b], *r[1:]) for b, r in zip(ends, rest)])


def asked_words(blocks: DataFrame, n_shards: int, hot: np.ndarray) -> DataFrame:
    """``pid, wp, h, r, n, words``: the distinct words of each shard, by the shard ``wp`` that holds the word (null ``h``), and
    those seen after each hot history ``h`` in training. Rows with ``r`` hold ``n`` bigrams of count r (of all histories, or of
    the hot ``h``), under r = 0 the occurrences of ``h``."""
    out = schema("pid int, wp int, h long, r int, n long, words binary")
    types = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())

    def ask(key, rows):
        pid, s = key[0].as_py(), open_shard(rows, False)
        out_rows: list[tuple] = []

        def words(w, h):
            cut = np.searchsorted(shard(w, n_shards), np.arange(n_shards + 1))
            for p in np.flatnonzero(np.diff(cut)):
                part = w[cut[p]:cut[p + 1]]
                out_rows.append((pid, int(p), h, None, len(part), pack(steps(part))))

        def counts(c, h):
            for r, n in enumerate(np.bincount(np.minimum(c, CUTOFF + 2), minlength=CUTOFF + 2)[1:CUTOFF + 2], 1):
                out_rows.append((None, None, h, r, int(n), None))

        words(s.words, None)
        counts(s.c[s.c > 0], None)
        at = np.flatnonzero((s.c > 0) & among(s.h, hot))
        first = _runs(s.h[at])
        for x, y in zip(first, np.append(first, len(at))[1:]):
            i = at[x:y]
            h = int(s.h[i[0]].view(np.int64))
            words(s.words[s.w[i]], h)
            counts(s.c[i], h)
            out_rows.append((None, None, h, 0, int(s.c[i].sum()), None))
        return pa.table([pa.array(v, type=t) for v, t in zip(zip(*out_rows), types)], names=out.names)

    return blocks.groupBy("pid").applyInArrow(ask, out)


def answered_words(asked: DataFrame, words: DataFrame, uni: Unigrams, n_shards: int) -> DataFrame:
    """``pid, wp, h, n, counts, p``: the counts of the asked words, in their order; for a hot ``h`` the sum of P of its words."""
    out = schema("pid int, wp int, h long, n long, counts binary, p double")

    def answer(key, left, right):
        of, count = right.column("w").to_numpy().astype(np.int64).view(_U), right.column("c").to_numpy()
        order = np.argsort(of)
        of, count = of[order], count[order]
        rows: list[tuple] = []
        for pid, wp, h, n, block in zip(*(left.column(c).to_pylist() for c in ("pid", "wp", "h", "n", "words"))):
            c = count[np.searchsorted(of, np.cumsum(unpack(block, (_U, n))[0], dtype=_U))].astype(np.int64)
            rows.append((pid, wp, h, n, pack(c) if h is None else None, None if h is None else float(uni.prob(c).sum())))
        types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.float64())
        return pa.table([pa.array(v, type=t) for v, t in zip(zip(*rows) if rows else [[]] * 6, types)], names=out.names)

    dealt = words.select(shard_sql("w", n_shards).alias("wp"), "w", "c")
    return asked.where("wp is not null").groupBy("wp").cogroup(dealt.groupBy("wp")).applyInArrow(answer, out)


class KatzModel(NamedTuple):
    """The scalars of the model, its ``blocks`` with texts, the word counts of each shard (``answers``) and the sums of the hot
    histories: ``hot`` (sorted), and for each c(h), discounted count and unigram mass of the seen successors."""
    unigrams: Unigrams
    d: np.ndarray
    blocks: DataFrame
    answers: DataFrame
    hot: np.ndarray
    hot_sums: np.ndarray


def train(src: DataFrame, n_shards: int) -> KatzModel:
    """Counts and weights from the texts that are not held out; at least ``n_shards`` shards."""
    words = materialize(word_counts(src), "katz-words")
    small = [F.sum((F.col("c") == r).cast("long")).alias(f"n{r}") for r in range(1, CUTOFF + 2)]
    s = words.agg(F.sum("c").alias("total"), F.sum("a").alias("all"), F.sum((F.col("c") > 0).cast("long")).alias("types"), *small).first()
    uni = Unigrams(s["total"] or 0, s["types"] or 0, {r: s[f"n{r}"] or 0 for r in range(1, CUTOFF + 2)})
    tokens = s["all"] or 0
    n_shards = max(n_shards, -(-tokens // SHARD_TOKENS))
    # Fewer than 4 * n_shards words can have more than this share of all tokens. A start precedes as many tokens as there are ends.
    often = words.where(F.col("a") * (4 * n_shards) > tokens).select("w").collect()
    hot = np.array([r["w"] for r in often], dtype=np.int64).view(_U)
    hot = np.sort(np.where(hot == END, START, hot))

    asked = materialize(asked_words(bigram_blocks(src, n_shards, hot, False), n_shards, hot), "katz-asked")
    answers = materialize(answered_words(asked, words, uni, n_shards), "katz-answers")
    counted = asked.where("r is not null").groupBy("h", "r").agg(F.sum("n").alias("n")).collect()  # some rows for each hot history
    n = {(r["h"], r["r"]): r["n"] for r in counted}
    d = discounts({r: x for (h, r), x in n.items() if h is None})
    mass = {r["h"]: r["p"] for r in answers.where("h is not null").groupBy("h").agg(F.sum("p").alias("p")).collect()}
    sums = np.zeros((3, len(hot)))
    for i, h in enumerate(hot.view(np.int64).tolist()):
        c = n.get((h, 0), 0)
        sums[:, i] = c, c - sum(n.get((h, r), 0) * r * (1 - d[r]) for r in range(1, CUTOFF + 1)), mass.get(h, 0.0)
    return KatzModel(uni, np.array([*d, 1.0]), bigram_blocks(src, n_shards, hot, True), answers.where("h is null"), hot, sums)


def log_probabilities(s: Shard, cw: np.ndarray, model: tuple) -> np.ndarray:
    """log10 P(w|h) of each bigram of a shard; ``cw``: the training count of each bigram's word."""
    uni, d, hot, hot_sums = model
    unigram = uni.prob(cw)
    seen = s.c > 0
    discounted = d[np.minimum(s.c, CUTOFF + 1)] * s.c
    first = _runs(s.h)
    sums = np.stack([np.add.reduceat(x, first) for x in (s.c.astype(np.float64), discounted, np.where(seen, unigram, 0.0))])
    h = s.h[first]
    is_hot = among(h, hot)
    sums[:, is_hot] = hot_sums[:, np.searchsorted(hot, h[is_hot])]
    c, m, p = sums
    share, most = m / np.maximum(c, 1), 1 - 0.5 / np.maximum(c, 1)
    f = np.where(share > most, most / np.maximum(share, 1e-300), 1.0)
    alpha = np.where(c > 0, (1 - np.minimum(share, most)) / (1 - np.where(c > 0, p, 0.0)), 1.0)
    many = np.diff(first, append=len(s.h))
    direct = np.repeat(f / np.maximum(c, 1), many) * discounted
    return np.log10(np.where(seen, direct, np.repeat(alpha, many) * unigram))


def _scored(model: KatzModel) -> DataFrame:
    """Partial sums of each batch and shard, summed per batch: one row per text."""
    uni, scalars = model.unigrams, (model.unigrams, model.d, model.hot, model.hot_sums)
    part = schema("batch long, size int, nt int, sums binary, ids binary, held binary, tokens binary")
    log_all = math.log10(uni.total + uni.types + 1)

    def score(key, left, right):
        s = open_shard(left, True)
        got = sorted(zip(*(right.column(c).to_pylist() for c in ("wp", "n", "counts"))))
        counts = [unpack(block, (np.int64, n))[0] for _, n, block in got]
        rows: list[tuple] = []
        if len(s.h):
            cw = np.concatenate(counts)[s.w]
            values = [log_probabilities(s, cw, scalars), np.log10(cw + 1) - log_all, (cw > 0).astype(np.float64)]
        else:
            values = [np.zeros(0)] * 3
        for (at, n, text, times), *own in zip(s.blocks, *(left.column(c).to_pylist() for c in ("batch", "size", "ids", "held", "tokens"))):
            held_here, text = np.unique(text, return_inverse=True)
            score, base, known = (np.bincount(text, weights=np.repeat(v[at], n) * times, minlength=len(held_here)) for v in values)
            sums = pack(held_here, score.astype(np.float64), base.astype(np.float64), known.astype(np.uint32))
            rows.append((own[0], own[1], len(held_here), sums, *own[2:]))
        types = (pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4)
        return pa.table([pa.array(v, type=t) for v, t in zip(zip(*rows), types)], names=part.names)

    out = schema("id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

    def total(key, group):
        size = group.column("size")[0].as_py()
        score, base, known = np.zeros(size), np.zeros(size), np.zeros(size, dtype=np.int64)
        for nt, sums in sorted(zip(group.column("nt").to_pylist(), group.column("sums").to_pylist())):
            text, a, b, c = unpack(sums, (np.uint16, nt), (np.float64, nt), (np.float64, nt), (np.uint32, nt))
            score[text] += a
            base[text] += b
            known[text] += c
        one = lambda name, t: next(np.frombuffer(b, dtype=t) for b in group.column(name).to_pylist() if b is not None)
        return pa.table([pa.array(one("ids", np.int64)), pa.array(one("held", np.bool_)), pa.array(one("tokens", np.int64)), pa.array(known),
                         pa.array(np.full(size, uni.total, dtype=np.int64)), pa.array(base), pa.array(score)], names=out.names)

    partial = model.blocks.groupBy("pid").cogroup(model.answers.groupBy("pid")).applyInArrow(score, part)
    return partial.groupBy("batch").applyInArrow(total, out)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one
    unigrams) and ``score`` (log10 probability of the text under the Katz model of the other texts)."""
    src = _source(docs, id_col, text_col)
    scored = _scored(train(src, width(docs.sparkSession)))
    return scored.withColumn("id", own_id("id")).withColumnRenamed("id", id_col)
