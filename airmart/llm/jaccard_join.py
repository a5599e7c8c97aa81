"""Exact n-gram Jaccard join by PartEnum signatures, and the components of its links.

A document's set holds the hashes of its distinct word n-grams. Sets of similarity ``t`` or more, the smaller
of size a, differ in at most ``k = a * (1 - t) / t`` elements. Sizes are cut into bands; in a band the feature
domain is cut into first-level partitions, more than ``k / 2`` of them, and each of these into three. Two sets
within ``k`` differ by at most one element in some first-level partition, so they agree on two of its three
parts: every two-of-three subset gives a signature (the hash of the elements in it), and such a pair shares at
least one. A set next to the lower border of its band also takes the signatures of the band below, so equal
parameters meet across borders. No link is lost; candidates are then verified on their whole sets.

Subsets that hold no element would match between all sets. They give no signature; instead each band has as
many spare first-level partitions as its sets have such partitions by expectation plus three deviations, and
the few sets with more also take signatures for their empty subsets (only such sets can need them).

Groups: equal sets are one class before any join. In a signature bucket every class is first compared with one
hub (the class in most buckets), which links a large group with as many comparisons as members; a second round takes
the hub from the classes that the first left apart. Classes of one bucket that are in different components after that
are paired off where a bucket has far fewer pairs of them than their sets have elements (``SMALL``), and those under one hub
where these are more than ``PAIRED``: the rows of a bucket or hub meet in a task (in tiles of ``TILE``), which tests sizes, the
parities of 256 bin counts and the counts themselves (a lower bound of the difference) and puts out only the pairs that pass. So
what is moved is a few hundred bytes a class and bucket, however many classes there are and however long their texts.
Under a hub of fewer classes they are not: each is described by its difference to that hub, at first by a few of the elements that the hub lacks, which leave
out classes that share too few of these with every class of another component. Two classes differ by the difference of
their differences, and as they are not both linked to the hub, a link needs a least number of common elements of these.
Elements are ordered by the number of classes under the hub that have them, rarest first, and those of one class only
are left out. So the two must share one of their first few elements, with enough others behind it, which is tested with the
parities while pairs are made. Every pair is then verified on the texts.

Edge cases: an empty or null text has an empty set, size 0, and is linked with nothing. A text with fewer
words than n is one n-gram. A node is an id with a text (a 64-bit hash of both): rows that share an id, or have none,
are linked by their own texts alone. Null ids order last; ``component_id`` is null where a text reaches no row
with an id. Other columns are not read. An empty table gives an empty one.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._components import components
from ._tables import arrow_batches, materialize, order_id, own_id, schema, width
from ._words import Words, grams, mix, slices

N_WORDS, PERCENT = 4, 85
BAND = 1.5      # ratio of the borders of a size band; above 100 / PERCENT
SMALL = 16      # a bucket of so many times fewer pairs than elements is paired off
PAIRED = 128    # so are the classes under a hub of more than that many, whose differences would take disk; fewer go by them
TILE = 8192     # classes that meet as many others at once
BINS = 256
BATCH_BYTES = 2 << 20  # of texts on their way to Python, beside the executor's heap
PARITY = [f"p{i}" for i in range(BINS // 64)]  # one bit a bin: whether its count is odd
_U = np.uint64


def bands(percent: int, top: int = 1 << 40) -> list[tuple[int, int, int]]:
    """(least size, first-level partitions, spare ones) of each band, from the least size that can differ."""
    out, lo = [], -(-percent // (100 - percent))  # a set of this size and one with one element more
    while lo < top:
        hi = max(lo + 1, math.floor(lo * BAND))
        need = (hi - 1) * (100 - percent) // percent // 2 + 1
        spare = 0
        for _ in range(8):
            n1 = need + spare
            mean = n1 * min(1.0, 3 * math.exp(-lo / n1 * 2 / 3))
            spare = math.ceil(mean + 3 * math.sqrt(mean)) if lo >= 24 else 0
            spare = min(spare, need)
        out.append((lo, need + spare, spare))
        lo = hi
    return out


def shingles(w: Words, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct n-grams of each text of a slice, ordered by row and hash."""
    g = grams(h, n)
    ok = w.rows_left()[:len(g)] >= n
    rows, vals = [w.doc[:len(g)][ok]], [g[ok]]
    counts = np.diff(w.first)
    for short in range(1, n):
        at = np.flatnonzero(counts == short)
        if len(at):
            rows.append(at)
            vals.append(grams(h, short, seed=32)[w.first[at]])
    row, val = np.concatenate(rows), np.concatenate(vals)
    order = np.lexsort((val, row))
    row, val = row[order], val[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (val[1:] != val[:-1])
    return row[new], val[new]


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, sum of their values modulo 2**64)."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(values[order], first)


def signatures(row: np.ndarray, val: np.ndarray, n_rows: int, percent: int, band_list) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of the sets of a slice."""
    size = np.bincount(row, minlength=n_rows)
    lows = np.array([b[0] for b in band_list])
    own = np.searchsorted(lows, size, side="right") - 1
    below = np.where((own > 0) & (percent * size <= 100 * (lows[np.maximum(own, 0)] - 1)), own - 1, -1)
    place, content = mix(val, 5), mix(val, 6)
    out_row, out_sig = [], []
    for band_of in (own, below):
        n1 = np.array([b[1] for b in band_list])[band_of]
        spare = np.array([b[2] for b in band_list])[band_of]
        live = band_of[row] >= 0
        r, c = row[live], content[live]
        base = np.concatenate(([0], np.cumsum(np.where(band_of >= 0, 3 * n1, 0))))
        cell = base[r] + (place[live] % (3 * n1[r]).astype(np.uint64)).astype(np.int64)
        total = np.zeros(base[-1], dtype=np.uint64)
        keys, sums = _sums(cell, c)
        total[keys] = sums
        full = np.zeros(base[-1], dtype=bool)
        full[keys] = True
        total, full = total.reshape(-1, 3), full.reshape(-1, 3)
        part_row = np.repeat(np.arange(n_rows), np.diff(base) // 3)
        part = np.arange(len(part_row)) - base[part_row] // 3
        label = mix(n1[part_row].astype(np.uint64) * _U(1 << 32) + part.astype(np.uint64), 7)
        pairs = ((0, 1), (0, 2), (1, 2))
        hollow = np.stack([~(full[:, a] | full[:, b]) for a, b in pairs], axis=1)
        many = np.bincount(part_row, weights=hollow.any(axis=1), minlength=n_rows) > spare
        for j, (a, b) in enumerate(pairs):
            use = ~hollow[:, j] | many[part_row]
            out_row.append(part_row[use])
            out_sig.append(mix(mix(total[use, a] + _U(1), 8) + mix(total[use, b] + _U(2), 9) + label[use] + _U(j), 10))
    return np.concatenate(out_row), np.concatenate(out_sig)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(node(id_col, text_col).alias("id"), order_id(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))


def node(id_col: str, text_col: str) -> Column:
    """What links hold: the row's id with its text."""
    return F.xxhash64(order_id(id_col), F.col(text_col).cast("string"))


def _over_sets(src: DataFrame, n: int, out, make, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` and ``make(ids, row, val)`` -> arrays, over the sets of each slice of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "text"):
                w = Words(data, off, lower=True)
                row, val = shingles(w, w.hashes(), n)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *make(np.asarray(part.column("id")), row, val)], names=out.names)

    return src.mapInArrow(run, out)


def set_prints(src: DataFrame, n: int) -> DataFrame:
    """``key, id, n, f1, f2, bins`` and ``PARITY`` of each row: own id, node, size, 128-bit fingerprint and bin counts of
    its set."""
    out = schema("key long, id long, n long, f1 long, f2 long, bins binary, " + ", ".join(f"{p} long" for p in PARITY))

    def make(ids, row, val):
        size = np.bincount(row, minlength=len(ids))
        f = []
        for seed in (11, 12):
            total = np.zeros(len(ids), dtype=np.uint64)
            keys, sums = _sums(row, mix(val, seed))
            total[keys] = sums
            f.append(pa.array(total.view(np.int64)))
        bins = np.bincount(row * BINS + (mix(val, 13) % _U(BINS)).astype(np.int64), minlength=len(ids) * BINS)
        raw = np.minimum(bins, 255).astype(np.uint8).reshape(len(ids), BINS)
        odd = np.packbits((bins & 1).astype(np.uint8).reshape(len(ids), BINS), axis=1).view(np.int64)
        return [pa.array(ids), pa.array(size), *f, pa.array([x.tobytes() for x in raw], type=pa.binary()), *(pa.array(x) for x in odd.T.copy())]

    return _over_sets(src, n, out, make, ("key",))


def set_signatures(src: DataFrame, n: int, percent: int, part: int = 0, parts: int = 1) -> DataFrame:
    """``sig, id`` of the signatures in the range ``part`` of ``parts`` equal ones."""
    out, band_list = schema("sig long, id long"), bands(percent)

    def make(ids, row, val):
        r, s = signatures(row, val, len(ids), percent, band_list)
        own = (s >> _U(32)) * _U(parts) >> _U(32) == _U(part)
        return [pa.array(s[own].view(np.int64)), pa.array(ids[r[own]])]

    return _over_sets(src, n, out, make)


def _shared(sorted_rows: DataFrame) -> DataFrame:
    """Rows of (sig, id) whose sig occurs with two ids or more; the rows come ordered, so one run at a time is held
    only as its first row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, while it is not known if its sig goes on
        for batch in batches:
            sig, ids = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            if not len(sig):
                continue
            if held is not None:
                sig, ids = np.concatenate(([held[0]], sig)), np.concatenate(([held[1]], ids))
                was = held[2]
            else:
                was = False
            new = np.ones(len(sig), dtype=bool)
            new[1:] = (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])
            sig, ids = sig[new], ids[new]
            joined = np.zeros(len(sig) + 1, dtype=bool)
            joined[1:-1] = sig[1:] == sig[:-1]
            keep = joined[:-1] | joined[1:]
            keep[0] |= was
            last_multi = bool(keep[-1])
            held = (sig[-1], ids[-1], last_multi)
            keep[-1] = False
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(sig[keep]), pa.array(ids[keep])], names=["sig", "id"])
        if held is not None and held[2]:
            yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[1]])], names=["sig", "id"])

    return sorted_rows.mapInArrow(run, schema("sig long, id long"))


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and bin counts allow a link (a bound, never a false refusal)."""
    x = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bins").alias("ba"))
    y = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bins").alias("bb"))
    rows = pairs.join(x, "a").join(y, "b").where(
        F.col("na") * percent <= F.col("nb") * 100).where(F.col("nb") * percent <= F.col("na") * 100).select("a", "b", "na", "nb", "ba", "bb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = len(batch)
            if not m:
                continue
            na, nb = np.asarray(batch.column(2)), np.asarray(batch.column(3))
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(m, BINS).astype(np.int16) for i in (4, 5))
            far = np.abs(left - right).sum(axis=1, dtype=np.int64)
            ok = pa.array(far * (100 + percent) <= (na + nb) * (100 - percent))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])

    return rows.mapInArrow(run, schema("a long, b long")).distinct()


def _sets_of(n: int):
    """text -> hashes of its n-grams, remembering the last few."""
    memo: dict[str, np.ndarray] = {}

    def set_of(text: str | None) -> np.ndarray:
        if text not in memo:
            if len(memo) >= 64:
                memo.clear()
            data = np.frombuffer((text or "").encode(), dtype=np.uint8)
            w = Words(data, np.array([0, len(data)]), lower=True)
            memo[text] = shingles(w, w.hashes(), n)[1]
        return memo[text]

    return set_of


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    return (pairs.hint("merge").join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .hint("merge").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose sets have the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        set_of = _sets_of(n)
        for batch in batches:
            ok = []
            for ta, tb in zip(batch.column(2), batch.column(3)):
                x, y = set_of(ta.as_py()), set_of(tb.as_py())
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            ok = pa.array(ok, type=pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])

    return _with_texts(pairs, texts).mapInArrow(run, schema("a long, b long")).distinct()


def _differences(spokes: DataFrame, texts: DataFrame, n: int, percent: int = 0) -> DataFrame:
    """``id, hub`` -> ``spoke, id, hub, n, d, elements``: the difference of the set to the hub's, as hashes of hub and
    element; ``spoke`` names the row, ``n`` is the set's size and ``d`` that of the difference. With a ``percent``, only the lowest
    elements that the hub lacks: twice as many, and one, as a linked set can lack (for ``_meeting``)."""
    out = schema("spoke long, id long, hub long, n long, d long, elements longs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        set_of = _sets_of(n)
        for batch in batches:
            for i in range(len(batch)):
                own, hub = set_of(batch.column(2)[i].as_py()), set_of(batch.column(3)[i].as_py())
                ids, hubs = batch.column(0).slice(i, 1), batch.column(1).slice(i, 1)
                of = np.asarray(hubs).view(np.uint64)
                rest = (np.setdiff1d if percent else np.setxor1d)(own, hub, assume_unique=True)
                rest = mix(rest + mix(of, 14), 15).view(np.int64)
                spoke = mix(np.asarray(ids).view(np.uint64) + mix(of, 16), 17).view(np.int64)
                d = len(rest)
                if percent:
                    rest = np.sort(rest)[:2 * (len(own) * (100 - percent) // 100) + 1]
                yield pa.RecordBatch.from_arrays([pa.array(spoke), ids, hubs, pa.array([len(own)]), pa.array([d]),
                                                  pa.ListArray.from_arrays(pa.array([0, len(rest)], pa.int32()), pa.array(rest))], names=out.names)

    return _with_texts(spokes.select(F.col("id").alias("a"), F.col("hub").alias("b")), texts).mapInArrow(run, out)


def _meeting(lowest: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """``id, hub`` of the classes that can have a link, given the lowest elements that the hub lacks. Of a class of ``n``
    elements a linked one lacks ``k = n * (1 - t)`` at most. So the lowest ``2k + 1`` of the one and of the other, each with
    its own ``k``, have the smaller ``k + 1`` in common at least, or all but ``k`` of a class that has fewer. Elements of one
    component only do not count. And as a linked class lacks ``k`` at most of the elements that the hub lacks, too, a class
    goes if none of another component has so few of them: a group of near copies of the hub has no use for far ones."""
    lacks = f"{100 - percent} div 100"
    lowest = lowest.join(label.hint("merge"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    rows = lowest.select("spoke", "label", F.explode("elements").alias("element"))
    shared = rows.groupBy("element").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("element")
    met = rows.select("spoke", "element").join(shared.hint("merge"), "element").groupBy("spoke").agg(F.count(F.lit(1)).alias("met"))
    least = F.expr(f"least((n * {percent} + 99) div 100 * {lacks} + 1, size(elements) - n * {lacks})")
    found = lowest.select("spoke", "id", "hub", "label", "d", F.expr(f"d - n * {lacks}").alias("more"), least.alias("least"))
    found = found.join(met.hint("merge"), "spoke", "left").where("coalesce(met, 0) >= least").select("id", "hub", "label", "d", "more")
    parts = found.groupBy("hub", "label").agg(F.min("more").alias("more"))
    first = parts.groupBy("hub").agg(F.min(F.struct("more", "label")).alias("first"))
    others = parts.join(first.hint("merge"), "hub").where("label <> first.label").groupBy("hub", "first").agg(F.min("more").alias("second"))
    found = found.join(others.hint("merge"), "hub").where("d >= if(label = first.label, second, first.more)")
    return found.select("id", "hub")


def _first_elements(differences: DataFrame, percent: int) -> DataFrame:
    """``element, spoke, left`` of the elements that a link of the class can need: under the order by number of classes,
    rarest first, ``left`` elements that another class has too remain from this one on. A class that differs by ``d``
    from the hub meets only classes that differ by ``d - k`` or more, so a link has ``d - k`` common elements at least."""
    # Written by hub; dealt out by class, or a task would open all classes of a large hub.
    dealt = differences.repartition(width(differences.sparkSession), "spoke")
    rows = dealt.select("spoke", F.explode("elements").alias("element"))
    count = rows.groupBy("element").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    common = rows.join(count.hint("merge"), "element").groupBy("spoke").agg(F.sort_array(F.collect_list(F.struct("c", "element"))).alias("common"))
    least = F.greatest(F.lit(1), F.expr(f"d - n * {100 - percent} div {percent}"))
    ranked = differences.select("spoke", least.alias("least")).join(common.hint("merge"), "spoke")
    first = F.expr("slice(common, 1, cast(greatest(size(common) - least + 1, 0) as int))")
    ranked = ranked.select("spoke", F.size("common").alias("size"), F.posexplode(first).alias("pos", "e"))
    return ranked.select(F.col("e.element").alias("element"), "spoke", (F.col("size") - F.col("pos")).cast("long").alias("left"))


def _near(same: bool, x: np.ndarray, y: np.ndarray, label, n, parity, bins, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (one of ``x``, one of ``y``, both in order of ``n``) of classes whose sizes, bin parities and bin counts allow a
    link, in different components; with ``same``, ``x`` and ``y`` are one list and a pair is given once."""
    ny, block = n[y], 128
    for at in range(0, len(x), block):
        i = x[at:at + block]
        a = int(np.searchsorted(ny * 100, n[i[0]] * percent, side="left"))
        b = int(np.searchsorted(ny * percent, n[i[-1]] * 100, side="right"))
        a = max(a, at + 1) if same else a
        if a >= b:
            continue
        j = y[a:b]
        nx, nj = n[i][:, None], n[j][None, :]
        ok = (label[i][:, None] != label[j][None, :]) & (nx * percent <= nj * 100) & (nj * percent <= nx * 100)
        if same:
            ok &= np.arange(a, b)[None, :] > np.arange(at, at + len(i))[:, None]
        odd = sum(np.bitwise_count(parity[i, w][:, None] ^ parity[j, w][None, :]).astype(np.uint16) for w in range(parity.shape[1]))
        u, v = np.nonzero(ok & (odd <= (nx + nj) * (100 - percent) // (100 + percent)))
        for c in range(0, len(u), 4096):
            p, q = i[u[c:c + 4096]], j[v[c:c + 4096]]
            far = np.abs(bins[p].astype(np.int16) - bins[q]).sum(axis=1, dtype=np.int64)
            ok = far * (100 + percent) <= (n[p] + n[q]) * (100 - percent)
            if ok.any():
                yield p[ok], q[ok]


def _near_pairs(rows: DataFrame, sets: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """``bucket, id, tiles`` -> pairs (a, b) of a bucket that are in different components and pass the tests of ``_near``. Classes are
    dealt out to ``tiles`` tiles of their bucket, and each two tiles (and each with itself) meet somewhere."""
    about = sets.join(label.hint("merge"), "id", "left").select("id", F.coalesce("label", "id").alias("label"), "n", *PARITY, "bins")
    dealt = rows.withColumn("tile", F.expr("cast(pmod(xxhash64(id, bucket), tiles) as int)")).withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    dealt = dealt.select("bucket", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), "tile", "id").join(about.hint("merge"), "id")
    dealt = dealt.select("bucket", "lo", "hi", "tile", "id", "label", "n", *PARITY, "bins").repartition(width(rows.sparkSession), "bucket", "lo", "hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # the parts of a group that may go on in the next batch

        def met(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            _, lo, hi, tile, ids, label, n, parity, bins = parts[0] if len(parts) == 1 else (np.concatenate(c) for c in zip(*parts))
            order, same = np.argsort(n, kind="stable"), lo[0] == hi[0]
            x, y = (order, order) if same else (order[tile[order] == lo[0]], order[tile[order] == hi[0]])
            found = list(_near(same, x, y, label, n, parity, bins, percent)) if len(x) and len(y) else []
            if found:
                a, b = (ids[np.concatenate(c)] for c in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            m, last = len(batch), 7 + len(PARITY)
            if not m:
                continue
            parity = np.stack([np.asarray(batch.column(i)).view(np.uint64) for i in range(7, last)], axis=1)
            bins = np.frombuffer(b"".join(batch.column(last).to_pylist()), dtype=np.uint8).reshape(m, BINS)
            columns = [*(np.asarray(batch.column(i)) for i in range(7)), parity, bins]
            new = np.ones(m, dtype=bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:3]])
            first = np.flatnonzero(new)
            for a, b in zip(first.tolist(), [*first[1:].tolist(), m]):
                part = [c[a:b] for c in columns]
                if held and any(held[0][k][0] != part[k][0] for k in range(3)):
                    yield from met(held)
                    held = []
                held.append(part)
        if held:
            yield from met(held)

    return dealt.sortWithinPartitions("bucket", "lo", "hi").mapInArrow(run, schema("a long, b long")).distinct()


def _cross(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that a link allows by their differences to a common hub: with ``k`` the
    most that linked sets of their sizes differ by, they share ``(dx + dy - k) / 2`` elements at least, all of them
    from the first common one on; and ``k`` bounds the bins of different parity."""
    d = F.col("x.d") + F.col("y.d")
    return _pairs(rows, "element", percent, lambda k: 2 * F.least("x.left", "y.left") >= d - k)


def _pairs(rows: DataFrame, key: str, percent: int, more=lambda k: F.lit(True)) -> DataFrame:
    """Pairs (a, b) of different components with an equal ``key`` whose sizes and bin parities allow a link, and ``more``."""
    x, y = rows.alias("x"), rows.alias("y")
    k = F.expr(f"(x.n + y.n) * {100 - percent} div {100 + percent}")
    odd = sum((F.bit_count(F.col(f"x.{p}").bitwiseXOR(F.col(f"y.{p}"))) for p in PARITY), F.lit(0))
    near = x.join(y, (F.col(f"x.{key}") == F.col(f"y.{key}")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.label") != F.col("y.label")) & more(k) & (odd <= k)
                  & (F.col("x.n") * percent <= F.col("y.n") * 100) & (F.col("y.n") * percent <= F.col("x.n") * 100))
    return near.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def _open(starred: DataFrame, label: DataFrame) -> DataFrame:
    """Rows of (sig, id, deg, hub, label) but the hubs themselves, of the buckets whose ``m`` other classes are in several components."""
    rows = starred.where("id <> hub").join(label, "id", "left").select("sig", "id", "deg", "hub", F.coalesce("label", "id").alias("label"))
    split = rows.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo <> hi")
    return rows.join(split.select("sig", "m").hint("merge"), "sig")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = N_WORDS,
                       percent: int = PERCENT) -> DataFrame:
    """One row per document: id, ``n_shingles`` and ``component_id`` (smallest id reachable by links)."""
    nodes = jaccard_nodes(docs, id_col, text_col, n_words, percent)
    return nodes.select(own_id("key").alias(id_col), F.col("n").alias("n_shingles"), own_id("first.key").alias("component_id"))


def jaccard_nodes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = N_WORDS,
                  percent: int = PERCENT, rounds: int = 1) -> DataFrame:
    """One row per document: ``key`` (its id in order), ``id`` (its node), ``n`` (n-grams) and ``first``, the key and id
    of the node of smallest key that links reach. Each of ``rounds`` ranges of
    the signatures is made and shuffled by itself: less disk for more time."""
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        return _nodes(docs, id_col, text_col, n_words, percent, rounds)


def _nodes(docs: DataFrame, id_col: str, text_col: str, n_words: int, percent: int, parts: int) -> DataFrame:
    spark, src = docs.sparkSession, _source(docs, id_col, text_col)
    prints = materialize(set_prints(src, n_words), "jaccard-sets")
    classes = prints.where("n > 0").groupBy("f1", "f2").agg(F.min(F.struct("key", "id")).alias("rep"))
    member = prints.select("key", "id", "n", "f1", "f2").join(classes, ["f1", "f2"], "left").withColumn("rep", F.coalesce("rep", F.struct("key", "id")))
    member = materialize(member.select("key", "id", "n", F.col("rep.id").alias("rep"), F.col("rep.key").alias("rep_key")), "jaccard-classes")
    # Tables that grow with the input meet by merge joins at every size. The next shuffles pass over all signatures, each once.
    rounds = [set_signatures(src, n_words, percent, part, parts).repartition(width(spark), "sig").sortWithinPartitions("sig", "id") for part in range(parts)]
    shared = functools.reduce(DataFrame.unionByName, [materialize(_shared(rows), "jaccard-shared") for rows in rounds])
    copies = member.where("id <> rep").select("id", "rep").distinct()
    by_class = shared.join(copies.hint("merge"), "id", "left").select("sig", F.coalesce("rep", "id").alias("id")).distinct()
    of_sig = by_class.groupBy("sig").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("sig")
    buckets = materialize(by_class.join(of_sig.hint("merge"), "sig"), "jaccard-buckets")
    degree = materialize(buckets.groupBy("id").agg(F.count(F.lit(1)).alias("deg")), "jaccard-candidates")
    buckets = buckets.join(degree.hint("merge"), "id")
    most = F.max_by("id", F.struct("deg", -F.col("id")))
    hubs = buckets.groupBy("sig").agg(most.alias("hub"))
    starred = materialize(buckets.join(hubs.hint("merge"), "sig"), "jaccard-hubs")
    found = degree.select("id")
    texts = materialize(src.select("id", "text").join(found.hint("merge"), "id", "left_semi").dropDuplicates(["id"]), "jaccard-texts")
    sets = materialize(prints.select("id", "n", "bins", *PARITY).join(found, "id", "left_semi").dropDuplicates(["id"]), "jaccard-bins")

    def star(spokes: DataFrame) -> DataFrame:
        pairs = spokes.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
        return materialize(_verified(materialize(_possible(pairs, sets, percent), "jaccard-star"), texts, n_words, percent), "jaccard-links")

    links = star(starred.where("id <> hub").select("id", "hub"))
    label = components(links)
    # A second hub, from the classes that are not in the first hub's component.
    apart = materialize(_open(starred, label).join(label.select(F.col("id").alias("hub"), F.col("label").alias("of")), "hub", "left")
                        .withColumn("of", F.coalesce("of", "hub")), "jaccard-apart")
    second = apart.where("label <> of").groupBy("sig").agg(F.max_by(F.struct("id", "label"), F.struct("deg", -F.col("id"))).alias("next"))
    links = links.unionByName(star(apart.join(second.hint("merge"), "sig").where("label <> next.label").select("id", F.col("next.id").alias("hub"))))
    label = components(links)

    # What the hubs could not settle: classes of a bucket in different components.
    left = _open(starred, label).select("sig", "id", "hub", "m").join(sets.select("id", "n").hint("merge"), "id")
    left = left.join(left.groupBy("sig").agg(F.sum("n").alias("elements")).hint("merge"), "sig")
    left = materialize(left.select("sig", "id", "hub", F.expr(f"m * (m - 1) div 2 * {SMALL} <= elements").alias("small")), "jaccard-open")
    under = left.where("not small").select("id", "hub").distinct()
    under = under.join(under.groupBy("hub").agg(F.count(F.lit(1)).alias("m")).hint("merge"), "hub")
    paired = left.where("small").select(F.col("sig").alias("bucket"), "id", F.lit(1).alias("tiles"))
    paired = paired.union(under.where(f"m > {PAIRED}").select("hub", "id", F.expr(f"cast((m + {TILE} - 1) div {TILE} as int)")))
    near = materialize(_near_pairs(paired, sets, label, percent), "jaccard-near")
    lowest = materialize(_differences(under.where(f"m <= {PAIRED}").select("id", "hub"), texts, n_words, percent), "jaccard-lowest")
    spokes = materialize(_meeting(lowest, label, percent), "jaccard-spokes")
    differences = materialize(_differences(spokes, texts, n_words), "jaccard-differences")
    about = differences.select("spoke", "id", "n", "d").join(sets.select("id", *PARITY), "id").join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
    rows = materialize(_first_elements(differences, percent).join(about.hint("merge"), "spoke"), "jaccard-elements")
    cross = materialize(_cross(rows, percent).union(near).distinct(), "jaccard-cross")
    cross = materialize(_possible(cross, sets, percent), "jaccard-pairs")  # by bin counts, before texts are sent
    label = components(links.unionByName(_verified(cross, texts, n_words, percent)))
    linked = label.join(member.where("id = rep").select("id", F.col("key")).distinct().hint("merge"), "id")
    lows = linked.groupBy("label").agg(F.min(F.struct("key", "id")).alias("first"))
    firsts = label.join(lows, "label").select(F.col("id").alias("rep"), "first")
    out = member.join(firsts, "rep", "left")
    return out.select("key", "id", "n", F.coalesce("first", F.struct(F.col("rep_key").alias("key"), F.col("rep").alias("id"))).alias("first"))
