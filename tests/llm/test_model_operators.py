"""Katz language model, URL filter, source mix and WARC round trip."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from airmart.llm import katz_lm, registry, source_mix, url_filter, warc

from . import brute


def test_katz_matches_brute_force_and_beats_unigrams(make_docs, small_docs):
    rnd = random.Random(7)
    phrases = [[f"v{rnd.randrange(60)}" for _ in range(4)] for _ in range(30)]
    docs = small_docs + [(10_000 + i, " ".join(w for _ in range(rnd.randrange(0, 20)) for w in rnd.choice(phrases)).title()) for i in range(150)]
    want = brute.katz(docs)
    got = {r.doc_id: r for r in katz_lm.score_documents(make_docs(docs)).collect()}
    assert got.keys() == want.keys()
    for i, (held, tokens, known, total, base, score) in want.items():
        g = got[i]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (held, tokens, known, total)
        assert math.isclose(g.base_score, base, rel_tol=1e-9, abs_tol=1e-9) and math.isclose(g.score, score, rel_tol=1e-9, abs_tol=1e-9)
    held = [g for g in got.values() if g.held_out]
    assert len(held) > 20 and sum(g.score for g in held) > sum(g.base_score for g in held)


def test_katz_shards_and_batches(make_docs, small_docs):
    """The number of shards, the batches (one for each partition here) and hot histories do not show in the scores."""
    docs = small_docs[:60] + [(500, "long text " * 3000), (501, " ".join(f"long t{i}" for i in range(900)))]
    want = brute.katz(docs)
    src = katz_lm._source(make_docs(docs).repartition(9), "doc_id", "text")
    for shards, hot in ((1, 0), (7, 2), (100, 5)):
        model = katz_lm.train(src, shards)
        assert len(model.hot) >= hot
        got = {r.id: r.score for r in katz_lm._scored(model).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[i], want[i][5], rel_tol=1e-9, abs_tol=1e-9) for i in want)


def test_katz_shards_grow_with_the_tokens(make_docs, small_docs, monkeypatch):
    """More tokens than a shard takes: more shards, the same scores."""
    monkeypatch.setattr(katz_lm, "SHARD_TOKENS", 500)
    want = brute.katz(small_docs)
    model = katz_lm.train(katz_lm._source(make_docs(small_docs), "doc_id", "text"), 2)
    assert model.blocks.select("pid").distinct().count() > 4
    got = {r.id: r.score for r in katz_lm._scored(model).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i][5], rel_tol=1e-9, abs_tol=1e-9) for i in want)


def test_katz_query_keeps_bigrams_seen_once(spark, make_docs, tmp_path):
    rnd = random.Random(11)
    docs = [(i, " ".join(f"v{rnd.randrange(40)}" for _ in range(rnd.randrange(0, 25)))) for i in range(60)]
    make_docs(docs).write.parquet(f"{tmp_path}/documents.parquet")
    want, cut = brute.katz(docs), brute.katz(docs, least=2)
    got = {r.doc_id: r.score for r in registry.queries()["op5_katz_lm"](spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i][5], rel_tol=1e-9, abs_tol=1e-9) for i in want)
    assert sum(not math.isclose(got[i], cut[i][5], rel_tol=1e-9) for i in want) > len(want) / 2


def test_katz_batches_number_their_texts():
    """An Arrow batch of more short texts than 16 bits can number is cut."""
    n = 150_000
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(np.zeros(n, dtype=bool)), pa.array(["a", None] * (n // 2))], names=["id", "held", "text"])
    ids = []
    for of, _, tok, _, text in katz_lm._tokens(iter([batch])):
        assert len(of) <= katz_lm.BATCH_TEXTS and (np.bincount(text, minlength=len(of)) == np.where(of % 2 == 0, 2, 1)).all() and len(tok) == len(text)
        ids.append(of)
    assert (np.concatenate(ids) == np.arange(n)).all()


def test_katz_edges(make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "a b a b a b"), (3, "a b a b a b"), (None, "A b")])
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in katz_lm.score_documents(docs).collect()))
    assert got == [(False, 1, 1), (False, 2, 1), (False, 3, 7), (False, 3, 7), (True, 0, 3)]
    assert katz_lm.score_documents(docs.limit(0)).count() == 0
    held = make_docs([(i, "only held out texts") for i in range(400) if brute.zlib.crc32(str(i).encode()) % 7 == 2][:5])
    assert {(r.held_out, r.n_known, r.train_tokens, r.base_score, r.score) for r in katz_lm.score_documents(held).collect()} == {(True, 0, 0, 0.0, 0.0)}


def test_katz_orders_tokens_either_way():
    rng = np.random.default_rng(2)
    h, w, text = rng.integers(0, 300, 5000), rng.integers(0, 500, 5000), np.sort(rng.integers(0, 60_000, 5000)).astype(np.uint16)
    want = sorted(zip(h.tolist(), w.tolist(), text.tolist()))
    for bits in (9, 23, 3):  # 3: too few for these numbers
        assert list(zip(*(x.tolist() for x in katz_lm.in_order(h, w, text, bits)))) == want


def test_pack_round_trip():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 1 << 64, 1000, dtype=np.uint64))
    n = rng.integers(0, 9, 50).astype(np.uint16)
    a, b = katz_lm.unpack(katz_lm.pack(katz_lm.steps(keys), n), (np.uint64, 1000), (np.uint16, 50))
    assert (np.cumsum(a) == keys).all() and (b == n).all()
    assert (np.diff(katz_lm.shard(keys, 13)) >= 0).all() and set(katz_lm.shard(keys, 13)) == set(range(13))


URLS = [None, "", "no scheme example.com/en/x", "http://Example.COM/en/a", "https://www.example.com/en/b?x=/fr/", "http://a.www.example.com/en/",
        "http://badexample.com/en/", "http://x.net/es/1", "http://net/fr/", "http://net.org/fr/", "http://com", "http://a.com?q=/", "ftp://h.com:80/en/",
        "http://a.net/esx", "x://y://z.com/", "http://a.net/fr/#top", "http://É.com/é"]


def _rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = tail[:min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_url_rules_match_brute_force(spark):
    real = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url").collect()]
    rows = list(enumerate(URLS + real + URLS))
    pages = spark.createDataFrame(rows + [(None, "http://q.org/")], "page_id int, url string").withColumn("rule", F.lit(1))
    got = url_filter.judge_urls(pages).collect()
    assert len(got) == len(rows) + 1
    by_id = {r.page_id: r for r in got}
    for i, u in rows:
        host, path, rule, verdict = _rule(u)
        r = by_id[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), u
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_url_model_separates_classes(spark):
    rnd = random.Random(2)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(10))
    good = [f"http://{word('abcde')}.com/{word('abcde')}" for _ in range(300)]
    bad = [f"http://{word('vwxyz')}.net/fr/{word('vwxyz')}" for _ in range(300)]
    free = [(f"http://{word('abcde')}.org/{word('abcde')}", "allow") for _ in range(100)] + [(f"http://{word('vwxyz')}.org/de/{word('vwxyz')}", "block") for _ in range(100)]
    pages = spark.createDataFrame(list(enumerate(good + bad + [u for u, _ in free])), "page_id int, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(pages).collect()}
    right = sum(got[600 + i] == v for i, (_, v) in enumerate(free))
    assert right >= 0.95 * len(free)


def test_url_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "p"), (1, "http://a.org/x", "p"), (2, None, None), (2, None, None), (None, "", "q")], "page_id int, url string, score string")
    got = sorted((r.page_id or 0, r.host, r.verdict, r.score) for r in url_filter.judge_urls(pages).collect())
    assert got == [(0, "", "allow", 0.0), (1, "a.org", "allow", 0.0), (1, "a.org", "allow", 0.0), (2, "", "allow", 0.0), (2, "", "allow", 0.0)]
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def _targets(sizes, total, weights=(5, 2, 1)):
    """Water filling by the definition: share by weight, cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed = {}
    while True:
        left, open_ = total - sum(fixed.values()), [s for s in names if s not in fixed]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 2.0 * sizes[s] for s in over}


def test_mix_targets_and_rules(make_docs, spark):
    rnd = random.Random(4)
    docs = [(i, " ".join(["w"] * rnd.randrange(0, 60)), rnd.choice(["b", "a", "é", "z", None, "b", "b"])) for i in range(900)]
    docs += [(2000 + i, "x y", "tiny") for i in range(3)] + [(3000, None, "empty"), (3001, "", "empty")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 900, 3)] + [(0, 1)], "doc_id long, quality int")
    got = source_mix.mix_plan(make_docs(docs), labels).collect()
    size = {}
    for _, t, s in docs:
        size[s] = size.get(s, 0) + len((t or "").split())
    want = _targets(size, 1.5 * sum(size.values()))
    taken, source = {}, {i: s for i, _, s in docs}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == size[s] and math.isclose(r.target, want[s], abs_tol=1e-6)
        assert r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        epochs = int(want[s] // size[s]) if size[s] else 0
        assert r.taken in (epochs * r.size, (epochs + 1) * r.size)
        taken[s] = taken.get(s, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 30 for s in size) and len(got) == len(docs)
    again = source_mix.mix_plan(make_docs(docs[::-1]).repartition(5), labels).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_mix_prefers_quality(make_docs, spark):
    docs = [(i, "one two three four", "a") for i in range(4000)] + [(9000 + i, "one two", "b") for i in range(20000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)] + [(9000 + i, i % 2) for i in range(20000)], "doc_id long, quality int")
    got = [r for r in source_mix.mix_plan(make_docs(docs), labels, ratio=0.5).collect() if r.doc_id >= 9000 and r.taken]
    good = sum(r.doc_id % 2 for r in got)
    assert 1.5 < good / (len(got) - good) < 2.2  # sampled in proportion to quality, without replacement


def test_mix_edges(make_docs):
    docs = make_docs([(1, None, None), (None, "a b c", "s"), (2, "a b c", "s"), (2, "a b c", "s")])
    got = sorted((r.doc_id or 0, r.size, r.taken) for r in source_mix.mix_plan(docs).collect())
    assert [x[:2] for x in got] == [(0, 3), (1, 0), (2, 3), (2, 3)] and sum(x[2] for x in got) in (12, 15)
    assert source_mix.mix_plan(docs.limit(0)).count() == 0
    assert {r.taken for r in source_mix.mix_plan(make_docs([(1, "", "s"), (2, None, "t")])).collect()} == {0}


TRAP = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n0\r\n\r\n"


def _pages():
    rnd = random.Random(8)
    rows = [(i, f"http://h/{i}", "".join(rnd.choice("aé\n\r<>𝄞 ") for _ in range(rnd.choice([0, 10, 999, 1000, 5000, 70_000])))) for i in range(40)]
    rows += [(100 + i, "http://h/t", TRAP * k) for i, k in enumerate([1, 30, 30, 900, 900, 900])]
    rows += [(200, None, None), (201, "", ""), (202, "http://a b\r\nc", "s"), (None, "u", TRAP * 30), (300, "u", TRAP * 900), (300, "u", TRAP * 900)]
    rows += [(400, "u", "\r\n" * 600), (401, "u", "\n")]
    return rows


def test_warc_round_trip(spark):
    rows = _pages()
    pages = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, segment string")
    got = warc.archive_round_trip(pages).collect()
    last = {}
    for i, _, h in rows:
        last[h] = max(last.get(h, -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = len(b) >= 1000 and (i is None or i != last[h])
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", last[h] if again else None))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_warc_segments_in_any_order(spark, tmp_dir):
    payload = (TRAP * 1500).encode()
    records = warc.page_records(7, "http://h", payload, None, False, "00000000-0000-0000-0000-000000000007")
    assert len(records) > 5
    write = lambda rs, path: spark.createDataFrame([(r.decode(),) for r in rs], "value string").write.option("lineSep", "\r\n\r\n").text(path)
    write(records[::-1], f"{tmp_dir}/ok")
    r = warc.read_archives(spark, f"{tmp_dir}/ok").first()
    assert (r.page_id, r.payload_bytes, r.payload_digest) == (7, len(payload), hashlib.sha1(payload).hexdigest())
    for name, broken in (("lost", records[:2] + records[3:]), ("short", records[:-1]), ("twice", records + records[1:2])):
        write(broken, f"{tmp_dir}/{name}")
        with pytest.raises(Exception, match="not whole"):
            warc.read_archives(spark, f"{tmp_dir}/{name}").collect()


def test_chunked_framing():
    assert warc.dechunk(b"5;ext=1\r\nhello\r\n1\r\n!\r\n0\r\nTrailer: x\r\n\r\n") == b"hello!"
    for bad in (b"5\r\nhell", b"5\r\nhelloX\r\n0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.dechunk(bad)


def test_katz_batches_are_small():
    """A task numbers and orders a batch of tokens as whole arrays, so batches bound its memory."""
    text = " ".join(f"w{i}" for i in range(9_999))
    batches = (pa.RecordBatch.from_pydict({"id": np.arange(10 * i, 10 * i + 10), "held": [False] * 10, "text": [text] * 10}) for i in range(12))
    sizes = [len(tok) for _, _, tok, _, _ in katz_lm._tokens(batches)]
    assert sum(sizes) == 1_200_000 and max(sizes) <= 600_000
