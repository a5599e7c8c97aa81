"""Line dedup, n-gram Jaccard join and substring dedup against brute force."""

import functools
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airmart.llm import jaccard_join, katz_lm, line_dedup, registry, substring_dedup
from airmart.llm._components import components
from airmart.llm._words import SLICE_BYTES

from . import brute


def _near_copies(seed, groups=12, size=6, length=(6, 120)):
    """Groups of texts with growing numbers of word edits, some exact copies, some short texts."""
    rnd = random.Random(seed)
    docs, i = [], 0
    for _ in range(groups):
        base = [f"v{rnd.randrange(400)}" for _ in range(rnd.randrange(*length))]
        for k in range(size):
            w = list(base)
            for _ in range(k // 2):
                w[rnd.randrange(len(w))] = f"v{rnd.randrange(400)}"
            docs.append((i, " ".join(w)))
            i += 1
    rnd.shuffle(docs)
    return [(k, t) for k, (_, t) in enumerate(docs)]


def test_lines_and_chunks_follow_split():
    rnd = random.Random(1)
    texts = ["\n".join(rnd.choice(["", "a", "b c", "d é"]) for _ in range(rnd.randrange(1, 30))).encode() for _ in range(50)] + [b""]
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    lines = line_dedup.Lines(np.frombuffer(b"".join(texts), dtype=np.uint8), off)
    raw = b"".join(texts)
    for i, t in enumerate(texts):
        assert [raw[lines.start[j]:lines.end[j]] for j in range(lines.first[i], lines.first[i + 1])] == t.split(b"\n")
    a, b = line_dedup.chunks(lines)
    assert a[0] == 0 and b[-1] == len(lines.row) and (a[1:] == b[:-1]).all()
    assert (lines.row[a] == lines.row[b - 1]).all()
    lengths = np.diff(lines.first)
    assert all(y - x >= line_dedup.MIN_LINES or lengths[lines.row[x]] == 1 for x, y in zip(a, b))


def _brute_lines(docs):
    """Chunk each text by itself; a chunk with a word goes if its bytes came before (by id)."""
    seen, out = set(), {}
    for i, t in sorted(docs):
        raw = (t or "").encode()
        a, b = line_dedup.chunks(line_dedup.Lines(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)])))
        all_lines, kept, gone = raw.split(b"\n"), [], 0
        for x, y in zip(a, b):
            c = b"\n".join(all_lines[x:y])
            if y - x >= 2 and c.split() and c in seen:
                gone += y - x
                continue
            seen.add(c)
            kept += all_lines[x:y]
        out[i] = (len(all_lines), gone, b"\n".join(kept))
    return out


def _passages(seed, n=120):
    rnd = random.Random(seed)
    shared = ["\n".join(f"shared {k} line {j} of it" for j in range(12)) for k in range(5)]
    docs = []
    for i in range(n):
        own = [f"own {i} {j}" for j in range(rnd.randrange(0, 6))]
        at = rnd.randrange(len(own) + 1)
        docs.append((i, "\n".join([*own[:at], rnd.choice(shared), *own[at:]])))
    return docs


def test_line_dedup_matches_brute_force(make_docs, small_docs):
    docs = small_docs + [(10_000 + i, t) for i, t in _passages(2)]
    want = _brute_lines(docs)
    got = line_dedup.line_report(make_docs(docs)).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed_lines, r.kept_sha256) for r in got} == {i: (n, g, hashlib.sha256(t).hexdigest()) for i, (n, g, t) in want.items()}
    clean = line_dedup.clean_documents(make_docs(docs)).collect()
    assert {r.doc_id: r.text for r in clean} == {i: t.decode() for i, (_, g, t) in want.items() if not g or t.split()}
    assert all(r.n_chars == len(r.text) for r in clean)


def test_line_chunks_resist_shifts(make_docs):
    passage = "\n".join(f"line {j} of a long shared passage" for j in range(60))
    docs = make_docs([(1, passage), (2, "one more line before\n" + passage), (3, passage + "\nand one after")])
    gone = {r.doc_id: r.n_removed_lines for r in line_dedup.line_report(docs).collect()}
    assert gone[1] == 0 and gone[2] >= 50 and gone[3] >= 50


def test_line_runs_match_brute_force(make_docs, tmp_path):
    """Planted passages of 2 to 6 lines in texts of few lines: every repeated run goes, as the query counts it."""
    rnd = random.Random(21)
    shared = [[f"passage {k} line {j}" for j in range(2 + k % 5)] for k in range(15)]
    docs = [(i, "\n".join([*(f"own {i} {j}" for j in range(rnd.randrange(0, 4))), *rnd.choice(shared), *(f"tail {i} {j}" for j in range(rnd.randrange(0, 3)))])) for i in range(90)]
    docs += [(200, "a\na\na"), (201, "b\nb\nb\nb"), (202, "single"), (203, None), (204, "\n\n\n")]
    first, want = {}, {}
    for i, t in docs:
        lines, gone = (t or "").split("\n"), set()
        for j, pair in enumerate(zip(lines, lines[1:])):
            at = first.setdefault(pair, (i, j))
            if any(pair) and (at[0] != i or j - at[1] >= 2):
                gone |= {j, j + 1}
        want[i] = (len(gone), hashlib.sha256("\n".join(x for j, x in enumerate(lines) if j not in gone).encode()).hexdigest())
    make_docs(docs).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_removed_lines, r.kept_sha256) for r in registry.queries()["op1_line_dedup"](make_docs(docs).sparkSession, str(tmp_path)).collect()}
    assert got == want and sum(n for n, _ in want.values()) > 200


def test_line_dedup_compares_bytes(make_docs, monkeypatch):
    """With a hash that sees only chunk lengths, different chunks clash; their bytes keep them apart."""
    monkeypatch.setattr(line_dedup, "_chunk_hashes", lambda lines, a, b: [(b - a).astype(np.uint64)] * 2)
    docs = [(1, "a\nb"), (2, "c\nd"), (3, "a\nb"), (4, "e\nf\ng"), (5, "e\nf\ng")]
    got = {r.doc_id: r.n_removed_lines for r in line_dedup.line_report(make_docs(docs)).collect()}
    assert got == {1: 0, 2: 0, 3: 2, 4: 0, 5: 3}


def test_line_dedup_edges(make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "single"), (4, "single"), (None, "a\nb"), (5, "a\nb"), (6, "x\ny"), (6, "x\ny"), (7, "\n\n\n"), (8, "\n\n\n")])
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_removed_lines) for r in line_dedup.line_report(docs).collect()))
    assert got == [(False, 1, 0), (False, 2, 0), (False, 3, 0), (False, 4, 0), (False, 5, 0), (False, 6, 0), (False, 6, 0), (False, 7, 0), (False, 8, 0), (True, 0, 2)]
    clean = line_dedup.clean_documents(docs).collect()
    assert sorted((r.doc_id, r.text or "") for r in clean) == [(1, ""), (2, ""), (3, "single"), (4, "single"), (5, "a\nb"), (6, "x\ny"), (6, "x\ny"), (7, "\n\n\n"), (8, "\n\n\n")]
    assert next(r for r in clean if r.doc_id == 1).text is None and clean[0].asDict().keys() == docs.first().asDict().keys()
    assert line_dedup.line_report(docs.limit(0)).count() == 0 == line_dedup.clean_documents(docs.limit(0)).count()


@pytest.mark.parametrize("percent", [85, 80])
def test_similar_sets_share_a_signature(percent):
    """The scheme loses no pair: sets at the similarity and of all sizes share a signature."""
    rnd = np.random.default_rng(4)
    band_list = jaccard_join.bands(percent)
    for size in [*range(5, 60), 99, 150, 400, 1500]:
        for _ in range(6):
            a = rnd.integers(0, 1 << 63, size, dtype=np.uint64)
            gone = rnd.integers(0, size + 1)
            for keep in range(size, 0, -1):  # b: a without some elements and with others, just at the bound
                extra = int(keep * 100 / percent) - size
                if extra < 0 or 100 * keep < percent * (size + extra):
                    break
                b = np.concatenate((a[:keep], rnd.integers(0, 1 << 63, extra, dtype=np.uint64)))
                if keep != size - min(gone, size * (100 - percent) // 100) and keep != size:
                    continue
                row = np.concatenate((np.zeros(size, dtype=np.int64), np.ones(len(b), dtype=np.int64)))
                r, s = jaccard_join.signatures(row, np.concatenate((a, b)), 2, percent, band_list)
                if set(a.tolist()) != set(b.tolist()):
                    assert set(s[r == 0].tolist()) & set(s[r == 1].tolist()), (size, keep, extra)


def test_jaccard_components_match_brute_force(make_docs, small_docs):
    docs = small_docs + [(10_000 + i, t) for i, t in _near_copies(3)]
    want = brute.components(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(make_docs(docs)).collect()}
    assert got == want and sum(c != i for i, (_, c) in want.items()) > 30


def test_jaccard_chain_needs_second_look(make_docs):
    """A chain whose ends are far apart: links that no hub shows are found among the rest of the bucket."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(220)]
    docs = []
    for i in range(40):
        w = list(base)
        for k in range(i):
            w[(k * 5) % 220] = f"x{k}"
        docs.append((100 - i, " ".join(w)))
    rnd.shuffle(docs)
    want = brute.components(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(make_docs(docs)).collect()}
    assert got == want


def test_jaccard_edges(make_docs):
    t = "one two three four five six seven eight"
    docs = make_docs([(9, t), (3, t.upper()), (4, t + " nine"), (5, None), (6, ""), (7, "one two"), (8, "ONE  two"), (None, "lonely words of a row without id"),
                      (None, "other words"), (10, "Same row"), (10, "Same row"), (2, "the one two")])
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs).collect()), key=str)
    want = [(False, 9, 5, 3), (False, 3, 5, 3), (False, 4, 6, 4), (False, 5, 0, 5), (False, 6, 0, 6), (False, 7, 1, 7), (False, 8, 1, 7), (True, 0, 4, None),
            (True, 0, 1, None), (False, 10, 1, 10), (False, 10, 1, 10), (False, 2, 1, 2)]
    assert got == sorted(want, key=str)
    assert jaccard_join.jaccard_components(docs.limit(0)).count() == 0


def test_components_of_chain_and_star(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100, 140)] + [(7, 200 + i) for i in range(50)] + [(220, 3), (5, 6), (6, 5)], "a long, b long")
    got = {r.id: r.label for r in components(links).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{200 + i: 3 for i in range(50)}, 7: 3, 3: 3, 5: 5, 6: 5}
    assert components(links.limit(0)).count() == 0


def _windows_corpus(seed):
    rnd = random.Random(seed)
    passages = [[f"p{k}w{j}" for j in range(rnd.randrange(11, 60))] for k in range(8)]
    docs = []
    for i in range(120):
        w = [f"q{rnd.randrange(30)}" for _ in range(rnd.randrange(0, 50))]
        for _ in range(rnd.randrange(0, 3)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p))
            at = rnd.randrange(len(w) + 1)
            w[at:at] = p[a:a + rnd.randrange(1, 40)]
        docs.append((i, " ".join(w)))
    docs += [(200 + i, "x y " * rnd.randrange(5, 60)) for i in range(20)]
    return docs


def test_substring_dedup_matches_brute_force(make_docs, small_docs):
    docs = small_docs + [(10_000 + i, t) for i, t in _windows_corpus(6)]
    rows = substring_dedup.remove_copies(make_docs(docs), with_factors=True).collect()
    want = brute.substring_dedup(docs)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == want
    for r in rows:
        assert sum(b - a for a, b in zip(r.factors[::2], r.factors[1::2])) == r.n_removed
        assert all(b - a >= substring_dedup.WINDOW for a, b in zip(r.factors[::2], r.factors[1::2]))
        assert hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256


def test_substring_edges(make_docs):
    t = " ".join(f"w{i}" for i in range(13))
    docs = make_docs([(1, None), (2, ""), (3, "\n "), (5, t), (5, t), (5, t + " x"), (None, t), (None, "y " + t), (6, t[:-4]), (7, " ".join(f"long{i % 501}" for i in range(50_000)))])
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed) for r in substring_dedup.remove_copies(docs).collect()))
    assert got == [(False, 1, 0, 0), (False, 2, 0, 0), (False, 3, 0, 0), (False, 5, 13, 0), (False, 5, 13, 0), (False, 5, 14, 0), (False, 6, 12, 0), (False, 7, 50_000, 0),
                   (True, 0, 13, 13), (True, 0, 14, 13)]
    assert substring_dedup.remove_copies(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed, bases", [(12, 1), (13, 1), (14, 3)])
def test_jaccard_large_bucket_by_differences(make_docs, monkeypatch, seed, bases):
    """Variants of a text, some too far from any hub, and texts that share half of their words: the hubs leave classes
    apart, and the differences find every link that brute force finds."""
    rnd = random.Random(seed)
    shared = [f"w{i}" for i in range(150 if bases == 1 else 100)]
    docs = []
    for i in range(90):
        w = shared + ([f"b{i % bases} {j}" for j in range(40)] if bases > 1 else [])
        for _ in range(rnd.randrange(0, 14)):
            at = rnd.randrange(len(w))
            w[at] = f"x{rnd.randrange(40)}"
        docs.append((i, " ".join(w)))
    want = brute.components(docs)
    assert len({c for _, c in want.values()}) > 5
    kept, write = {}, jaccard_join.materialize

    def spy(df, label, **options):
        kept.setdefault(label, []).append(write(df, label, **options))
        return kept[label][-1]

    monkeypatch.setattr(jaccard_join, "materialize", spy)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(make_docs(docs)).collect()}
    assert got == want
    assert kept["jaccard-elements"][0].count() > 0
    apart = {(r.a, r.b) for r in kept["jaccard-cross"][0].collect()}
    assert len(apart) < 90 * 89 // 4  # far from all pairs


def test_jaccard_small_buckets_need_no_differences(make_docs, monkeypatch):
    """Variants of a text that the hubs leave apart: a bucket of few is settled pair by pair."""
    rnd, docs = random.Random(12), []
    for i in range(15):  # 105 pairs, 15 * 147 elements
        w = [f"w{i}" for i in range(150)]
        for _ in range(rnd.randrange(0, 14)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(40)}"
        docs.append((i, " ".join(w)))
    want = brute.components(docs)
    assert len({c for _, c in want.values()}) > 2
    kept, write = {}, jaccard_join.materialize

    def spy(df, label, **options):
        kept[label] = write(df, label, **options)
        return kept[label]

    monkeypatch.setattr(jaccard_join, "materialize", spy)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(make_docs(docs)).collect()} == want
    assert kept["jaccard-differences"].count() == 0 and kept["jaccard-open"].count() > 0


def test_first_elements_hold_every_link(spark):
    """Differences to a hub as random sets: each pair with the common elements that a link needs meets in a first element."""
    rnd = random.Random(3)
    rows = []
    near = [set(rnd.sample(range(70), rnd.randrange(25, 40))) for _ in range(6)]
    for i in range(60):
        elements = near[i % 6] ^ set(rnd.sample(range(80), rnd.randrange(0, 9)))
        rows.append((i, i, rnd.randrange(100, 130), len(elements), sorted(elements)))
    differences = spark.createDataFrame(rows, "spoke long, id long, n long, d long, elements array<long>")
    first = jaccard_join._first_elements(differences, 85).select("element", "spoke", "left")
    about = differences.select("spoke", "id", "n", "d", F.col("id").alias("label"), *(F.lit(0).cast("long").alias(p) for p in jaccard_join.PARITY))
    got = {(r.a, r.b) for r in jaccard_join._cross(first.join(about, "spoke"), 85).collect()}
    want = set()
    for a, _, na, da, ea in rows:
        for b, _, nb, db, eb in rows:
            if a < b and 85 * na <= 100 * nb and 85 * nb <= 100 * na and len(set(ea) ^ set(eb)) <= (na + nb) * 15 // 185:
                want.add((a, b))
    assert want <= got and len(want) > 5


def test_jaccard_differences_without_a_near_class_are_not_written(make_docs, monkeypatch):
    """Texts that share half of their words meet in large buckets: of those with no near text no whole difference is
    written, and the links of the others are found. Texts go to Python in bounded batches."""
    rnd, docs = random.Random(21), []
    head = [f"w{i}" for i in range(75)]
    for i in range(120):
        docs.append((i, " ".join(head + [f"x{i}-{k}" for k in range(75)])))
    for i in range(6):  # linked with one of them each
        w = docs[10 * i][1].split(" ")
        w[rnd.randrange(len(w))] = "y"
        docs.append((200 + i, " ".join(w)))
    kept, write, sizes = {}, jaccard_join.materialize, set()

    def spy(df, label, **options):
        sizes.add(df.sparkSession.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"))
        kept.setdefault(label, []).append(write(df, label, **options))
        return kept[label][-1]

    monkeypatch.setattr(jaccard_join, "materialize", spy)
    data = make_docs(docs)
    before = data.sparkSession.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(data).collect()}
    assert got == brute.components(docs) and sum(c != i for i, (_, c) in got.items()) == 6
    assert sum(len(r.elements) for d in kept["jaccard-differences"] for r in d.collect()) < 120 * 100
    assert kept["jaccard-lowest"][0].count() >= 100
    pairs, cross = ({(r.a, r.b) for r in kept[k][0].collect()} for k in ("jaccard-pairs", "jaccard-cross"))
    assert pairs <= cross
    assert sizes == {str(jaccard_join.BATCH_BYTES)} and data.sparkSession.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


@pytest.mark.parametrize("percent", [80, 85])
def test_lowest_elements_keep_every_link(spark, make_docs, percent):
    """Of random variants of texts, each one linked with a class of another component is kept for the whole differences."""
    make_docs([])
    rnd, n, texts = random.Random(percent), 4, [(0, " ".join(f"w{i}" for i in range(120)))]
    for i in range(1, 80):
        w = [f"w{k}" for k in range(40 + 5 * (i % 3))] + [f"b{i % 7}-{k}" for k in range(60 + i % 11)]
        for _ in range(rnd.randrange(0, 8)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(20)}"
        texts.append((i, " ".join(w)))
    texts += [(i, " ".join(f"{i}-{k}" for k in range(90))) for i in range(80, 100)]
    sets = {i: {tuple(t.split()[k:k + n]) for k in range(len(t.split()) - n + 1)} for i, t in texts}
    linked = {i for i in range(1, 100) for j in range(1, 100) if i != j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])}
    table = spark.createDataFrame(texts, "id long, text string")
    spokes = spark.createDataFrame([(i, 0) for i in range(1, 100)], "id long, hub long")
    lowest = jaccard_join._differences(spokes, table, n, percent).cache()
    for r in lowest.collect():
        k = len(sets[r.id]) * (100 - percent) // 100
        assert r.d == len(sets[r.id] - sets[0]) and len(r.elements) == min(r.d, 2 * k + 1)
    none = spark.createDataFrame([], "id long, label long")
    kept = {(r.id, r.hub) for r in jaccard_join._meeting(lowest, none, percent).collect()}
    assert {(i, 0) for i in linked} <= kept and len(linked) > 10 and not kept & {(i, 0) for i in range(80, 100)}
    one = spark.createDataFrame([(i, 1) for i in range(100)], "id long, label long")
    assert jaccard_join._meeting(lowest, one, percent).count() == 0


def test_texts_of_equal_marks_stay_apart(spark, make_docs):
    """Two texts without an id whose 64-bit marks agree in 31 bits, a long and a short one, keep their own places."""
    tail = " ".join(f"w{k}" for k in range(20))
    lines = "\n".join(f"line {k} of it" for k in range(5))
    for operator, long, short in ((substring_dedup.remove_copies, tail, "x"), (functools.partial(line_dedup.line_report, runs=True), "\n" + lines, "x")):
        n = spark.range(150_000)
        kinds = [n.select(F.lit(kind).alias("kind"), F.concat(F.col("id").cast("string"), F.lit(f" {t}")).alias("text")) for kind, t in (("long", long), ("short", short))]
        for mark in (F.xxhash64("text"), F.hash("text")):
            a, b = (k.withColumn("m", mark.bitwiseAND(F.lit((1 << 31) - 1))).withColumnsRenamed({"text": f"t{i}"}).drop("kind") for i, k in enumerate(kinds))
            pair = a.join(b, "m").first()
            assert pair is not None
            rows = [(1, f"other {long}"), (None, pair["t0"]), (None, pair["t1"]), (7, pair["t0"]), (7, pair["t1"])]
            got = operator(make_docs(rows))
            gone = {(r[0], r[1]): r[2] for r in got.collect()}
            kept = {k: v for k, v in gone.items() if v == 0}
            assert len(got.collect()) == 5 and len(kept) == 3 and sorted(v > 0 for v in gone.values()).count(True) == 2, (operator, gone)
            assert all(n_units > 2 for (_, n_units), v in gone.items() if v)


def test_texts_larger_than_a_slice(make_docs):
    """Texts of more than two slices of bytes, a near copy and a part of one, among small ones."""
    rnd = random.Random(31)
    lines = [" ".join(f"t{rnd.randrange(90_000)}" for _ in range(12)) for _ in range(32_000)]
    large = "\n".join(lines)
    assert len(large) > 2 * SLICE_BYTES
    docs = [(1, "a few words"), (2, large), (3, None), (4, "\n".join(["another start", *lines[:31_000], "another end"])), (5, "\n".join(lines[20_000:20_400])), (6, "a few words")]
    pairs = [(i, set(zip((t or "").split("\n"), (t or "").split("\n")[1:]))) for i, t in docs]
    gone = {r.doc_id: r.n_removed_lines for r in line_dedup.line_report(make_docs(docs), runs=True).collect()}
    assert gone == {1: 0, 2: 0, 3: 0, 4: 31_000, 5: 400, 6: 0} and len(pairs[1][1] & pairs[3][1]) == 30_999
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(make_docs(docs)).collect()}
    assert got == brute.components(docs) and got[4][1] == 2 and got[5][1] == 5
    rows = substring_dedup.remove_copies(make_docs(docs)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == brute.substring_dedup(docs)
    want = brute.katz(docs)
    scores = {r.doc_id: r for r in katz_lm.score_documents(make_docs(docs)).collect()}
    assert all(math.isclose(scores[i].score, want[i][5], rel_tol=1e-9, abs_tol=1e-9) and scores[i].n_known == want[i][2] for i in want)


def test_near_pairs_are_those_of_the_bounds(spark, monkeypatch):
    """Pairs of a bucket by sizes, parities and bin counts are those of all pairs tested one by one, whatever the tiles; classes of
    one component and of other buckets do not meet."""
    rng, rnd = np.random.default_rng(8), random.Random(8)
    base = [rng.poisson(1.2, jaccard_join.BINS) for _ in range(4)]
    sets, label = [], {}
    for i in range(90):
        bins = np.maximum(base[i % 4] + (rng.random(jaccard_join.BINS) < rnd.random() / 4) * rng.choice([-1, 1], jaccard_join.BINS), 0)
        odd = np.packbits((bins & 1).astype(np.uint8)).view(np.int64).tolist()
        sets.append((i, int(bins.sum()), *odd, bytearray(bins.astype(np.uint8).tobytes())))
        if i % 3 == 0:
            label[i] = i % 5
    fields = "id long, n long, " + ", ".join(f"{p} long" for p in jaccard_join.PARITY) + ", bins binary"
    table, labels = spark.createDataFrame(sets, fields), spark.createDataFrame(list(label.items()), "id long, label long")
    member = [(7, i) for i in range(0, 90)] + [(-3, i) for i in range(40, 60)]
    want = set()
    for a, x in enumerate(sets):
        for y in sets[a + 1:]:
            far = sum(abs(p - q) for p, q in zip(x[-1], y[-1]))
            if label.get(x[0], x[0]) != label.get(y[0], y[0]) and 80 * x[1] <= 100 * y[1] and 80 * y[1] <= 100 * x[1] and far * 180 <= (x[1] + y[1]) * 20:
                want.add((x[0], y[0]))
    assert 50 < len(want) < 2000
    for tiles in (1, 3):
        rows = spark.createDataFrame([(b, i, tiles) for b, i in member], "bucket long, id long, tiles int")
        assert {(r.a, r.b) for r in jaccard_join._near_pairs(rows, table, labels, 80).collect()} == want
    alone = spark.createDataFrame([(i, i, 1) for i in range(90)], "bucket long, id long, tiles int")
    assert jaccard_join._near_pairs(alone, table, labels, 80).count() == 0


def test_jaccard_many_classes_under_a_hub_need_no_differences(make_docs, monkeypatch):
    """More classes under a hub than ``PAIRED``: no difference is written, pairs come from the sketches, and the links are those of
    brute force, with signatures in one round or three."""
    rnd, docs = random.Random(31), []
    head = [f"w{i}" for i in range(60)]
    for i in range(170):
        docs.append((i, " ".join(head + [f"x{i}-{k}" for k in range(60)])))
    for i in range(8):
        w = docs[20 * i][1].split(" ")
        w[rnd.randrange(len(w))] = "y"
        docs.append((200 + i, " ".join(w)))
    kept, write = {}, jaccard_join.materialize

    def spy(df, label, **options):
        kept.setdefault(label, []).append(write(df, label, **options))
        return kept[label][-1]

    monkeypatch.setattr(jaccard_join, "materialize", spy)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(make_docs(docs)).collect()}
    assert got == brute.components(docs) and sum(c != i for i, (_, c) in got.items()) == 8
    under = kept["jaccard-open"][0].groupBy("hub").agg(F.countDistinct("id").alias("m")).where("m > 128")
    assert under.count() > 0 and kept["jaccard-lowest"][0].join(under, "hub").count() == 0
    kept.clear()
    nodes = jaccard_join.jaccard_nodes(make_docs(docs), rounds=3)
    assert {r.key: (r.n, r.first.key) for r in nodes.collect()} == got and [t.count() > 0 for t in kept["jaccard-shared"]] == [True] * 3
