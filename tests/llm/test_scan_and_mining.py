"""License scan, hard-negative mining and phrase mining against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from airmart.llm import hard_negatives as hn
from airmart.llm import license_scan as ls
from airmart.llm import phrase_mining as pm
from airmart.llm.license_rules import BASE, build_rules

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
key = lambda row: tuple((x is None, x) for x in row)


# ---- license scan

def brute_license(text):
    """Every rule tried on every text; a detection falls if one other holds it."""
    words = WORD.findall((text or "").translate(FOLD))
    norm, rules = " ".join(words).encode(), build_rules()
    found = []
    for i, r in enumerate(rules):
        for m in r.pattern.finditer(norm):
            a = norm[:m.start()].count(b" ")
            found.append((a, a + m.group().count(b" ") + 1, i))
    def falls(d):
        a, b, i = d
        for x, y, j in found:
            if d == (x, y, j) or x > a or y < b or rules[j].priority > rules[i].priority:
                continue
            if rules[j].priority < rules[i].priority or (x, y) != (a, b) or j < i:
                return True
        return False
    kept = [d for d in found if rules[d[2]].base or not falls(d)]
    places = sorted(i for phrase, _ in BASE for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split())
    base = sorted({label for phrase, label in BASE if f" {phrase} " in f" {norm.decode()} "})
    labels = sorted({rules[i].label for _, _, i in kept})
    return (len(words), len(places), places[0] if places else None, places[-1] if places else None, ",".join(base), ",".join(labels),
            max((rules[i].relevance for _, _, i in kept), default=0.0), len(kept))


LICENSES = [
    "Released under the MIT License.", "Licensed under CC BY-NC 4.0. Under the MIT license, under the mit LICENSE!", "Apache License, Version 2.0 apache license version 22",
    "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-2.0-or-later\nAll rights reserved.",
    "under the terms of the GNU General Public License version 2 or any later version", "Permission is hereby granted, free of charge, to any person obtaining a copy "
    "of this software and associated documentation files (the Software)", "see https://creativecommons.org/licenses/by-nc-sa/4.0/ and opensource.org/licenses/MIT",
    "under the mit license", "UNDER THE MİT LICENSE under the mit licenses", "mit apache gnu license licence under the bsd", "released into the public domain"]
EDGES = [(1, None), (2, ""), (3, " \n .;"), (None, LICENSES[0]), (None, None), (5, "x " * 4_000 + LICENSES[1] + " y" * 4_000), (6, LICENSES[2]), (6, LICENSES[2])]


def test_rules_are_hundreds_and_gated():
    rules = build_rules()
    assert len(rules) >= 300 and len({(r.label, r.pattern.pattern) for r in rules}) > 300
    for text in LICENSES:  # the keywords lose nothing that a rule would find
        norm = " ".join(WORD.findall(text.translate(FOLD))).encode()
        tried = set(ls.candidates(norm))
        assert {i for i, r in enumerate(rules) if r.pattern.search(norm)} <= tried


def test_license_report(make_docs, small_docs):
    rng = random.Random(5)
    mixed = [(100 + i, " ".join(rng.choice(LICENSES) if rng.random() < 0.3 else rng.choice(["the", "mit", "under", "license", "gpl 2"]) for _ in range(30))) for i in range(25)]
    rows = EDGES + [(20 + i, t) for i, t in enumerate(LICENSES)] + mixed + small_docs[:20]
    got = ls.license_report(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(((i, *brute_license(t)) for i, t in rows), key=key)
    assert ls.license_report(make_docs(rows).limit(0)).collect() == []
    by = {t: brute_license(t) for t in LICENSES}
    assert by[LICENSES[3]][5] == "gpl-3.0" and by[LICENSES[4]][5] == "gpl-2.0-or-later,proprietary" and by[LICENSES[5]][5] == "gpl-2.0-or-later"
    assert by[LICENSES[8]][1] == 0  # a no-break space is part of a word


def test_license_in_a_long_text(make_docs):
    """A text of several slices, the phrase at its end."""
    row = ls.license_report(make_docs([(1, "mit License " * 900_000 + "UNDER the MIT-license"), (2, "a")])).where("doc_id = 1").first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.labels) == (1_800_004, 1, 1_800_000, 1_800_000, "mit", "mit")


def test_license_spans_cover_report(make_docs):
    docs = make_docs([(i, t) for i, t in enumerate(LICENSES)])
    spans = ls.license_spans(docs).collect()
    for r in ls.license_report(docs).collect():
        own = [s for s in spans if s.doc_id == r.doc_id]
        assert len(own) == r.n_detections and r.labels == ",".join(sorted({s.label for s in own}))
        assert all(0 <= s.first_word < s.end_word <= r.n_words for s in own)


# ---- hard negatives

def brute_negatives(rows):
    """Scores beyond 64 bits are held at the end of the range."""
    live = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        live.append((i, q, (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    for n, (i, q, label) in enumerate(live):
        if i is None or i % 100:
            continue
        s = [(-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(q, p)))), j is None, j or 0, j, m == label) for k, (j, p, m) in enumerate(live) if k != n and len(p) == len(q)]
        s.sort(key=lambda x: x[:3])
        for pos in [x for x in s if x[4]][:5]:
            hits = [x for x in s if not x[4] and 30 * -pos[0] <= 100 * -x[0] <= 90 * -pos[0]][:10]
            out += [(i, pos[3], k + 1, x[3], -pos[0], -x[0]) for k, x in enumerate(hits)]
    return sorted(out, key=key)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "vec_id long, embedding array<float>, label int, row int, id int, q string")


@pytest.mark.parametrize("seed", range(3))
def test_hard_negatives(spark, seed):
    from airmart.llm.registry import importable
    importable(spark)
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(0.2, 0.3, 6) * 4) / 4], int(rng.integers(0, 4))) for i in range(0, 900, 3)]
    rows += rows[:40] + [(None, rows[7][1], 1), (None, rows[7][1], 2), (300, None, 1), (600, [1.0] * 6, None), (500, [float("nan")] + [1.0] * 5, 1), (700, [float("inf")] * 6, 1),
                         (800, [None] + [1.0] * 5, 2), (100, [], 1), (200, [], 1), (201, [], 2), (400, [1.0, 2.0], 3), (401, [1.0, 2.0], 3), (402, [0.5, 1.0], 2)]
    if seed == 2:
        rows += [(1000, [1e15, 2.0], 3), (1001, [1e15, -2.0], 3), (1002, [4e14, 2.0], 2), (1003, [0.25, 4.0], 2)]  # products beyond doubles
    got = [tuple(r) for r in hn.hard_negatives(vectors(spark, rows)).collect()]
    want = brute_negatives(rows)
    assert want and sorted(got, key=key) == want


def test_hard_negatives_in_many_blocks(spark, monkeypatch):
    """Several groups of anchors and blocks of a few rows give the same lists; an empty table gives none."""
    monkeypatch.setattr(hn, "BLOCK_BYTES", 200)
    monkeypatch.setattr(hn, "GROUP_BYTES", 300)
    rng = np.random.default_rng(9)
    rows = [(int(i), [float(x) for x in rng.normal(0.3, 0.3, 5)], int(rng.integers(0, 2))) for i in range(0, 1500, 5)]
    assert sorted((tuple(r) for r in hn.hard_negatives(vectors(spark, rows)).collect()), key=key) == brute_negatives(rows)
    assert hn.hard_negatives(vectors(spark, rows).limit(0)).collect() == []


def test_scores_are_exact_at_every_size():
    block = lambda q: hn.Block(len(q[0]), *(np.zeros(len(q), dtype=np.int64).tobytes(),) * 2, np.zeros(len(q), dtype=bool).tobytes(),
                               np.zeros(len(q), dtype=np.int64).tobytes(), np.array(q, dtype=np.int64).tobytes(), b"")
    big = 1 << 30
    assert hn.scores(block([[big + 1, 3]]), block([[big - 1, 5], [1, 1]])).tolist() == [[(big + 1) * (big - 1) + 15, big + 4]]
    assert hn.scores(block([[1 << 62, 1]]), block([[1 << 62, 1], [-(1 << 62), 1]])).tolist() == [[(1 << 63) - 1, -(1 << 63)]]


# ---- phrases

def brute_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for m in range(1, 5):
                for i in range(len(ws) - m + 1):
                    f[lang, tuple(ws[i:i + m])] += 1
    out = {}
    for (lang, w), a in f.items():
        if len(w) < 2 or a < least:
            continue
        if any(lang == la and len(x) > len(w) and 100 * b >= 80 * a and any(x[i:i + len(w)] == w for i in range(len(x))) for (la, x), b in f.items()):
            continue
        score, k, left, right = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top]))


def phrase_docs(spark, rows):
    from airmart.llm.registry import importable
    importable(spark)
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], "lang string, text string, f int, phrase int, words int, w1 int, n int")


@pytest.mark.parametrize("alphabet, least", [("abc", 3), ("abcdefghij", 2), (["é", "\x01", "a\x00b", "ABC", " ", "日本"], 2)])
def test_phrases(spark, alphabet, least):
    rng = random.Random(str(alphabet))
    sep = [" ", " ", " ", "\t ", ". ", "\n", ",", "\x0b"]
    rows = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(alphabet) + rng.choice(sep) for _ in range(rng.randint(0, 60)))) for _ in range(40)]
    rows += [("en", None), (None, None), ("en", ""), ("fr", " .,\n"), rows[0], rows[0], ("long", "p q r s " * 30_000)]
    got = pm.ranked_phrases(phrase_docs(spark, rows), min_count=least, top=15).collect()
    assert sorted(tuple(r) for r in got) == brute_phrases(rows, least, 15)
    assert pm.ranked_phrases(phrase_docs(spark, rows).limit(0)).collect() == []


def test_pair_filter_loses_no_pair_and_every_bit_can_be_set(spark, monkeypatch):
    """Whatever the filter lets through, the counts are the same."""
    rng = random.Random(3)
    rows = [("en", " ".join(rng.choice("abcdef") for _ in range(80))) for _ in range(10)]
    docs = phrase_docs(spark, rows)
    want = brute_phrases(rows, 4, 100)
    monkeypatch.setattr(pm, "pair_filter", lambda pairs: b"\xff" * (pm.FILTER_BITS // 8))
    assert sorted(tuple(r) for r in pm.ranked_phrases(docs, min_count=4, top=100).collect()) == want
    monkeypatch.undo()
    assert sorted(tuple(r) for r in pm.ranked_phrases(docs, min_count=4, top=100).collect()) == want
    counts, _ = pm.frequent_counts(docs, min_count=4)
    filled = sum(bin(x).count("1") for x in pm.pair_filter(counts.where("size(split(phrase, ' ')) = 2")))
    assert 0 < filled <= counts.where("size(split(phrase, ' ')) = 2").count()


def test_words_of_one_hash_stay_apart(monkeypatch):
    """Words are numbered by two hashes."""
    data = np.frombuffer(b"ab cd ab", dtype=np.uint8)
    plain = pm.Pieces(data, np.array([0, 8]))
    assert plain.word.tolist() in ([0, 1, 0], [1, 0, 1]) and plain.left.tolist() == [3, 2, 1]
    real = pm.mix
    monkeypatch.setattr(pm, "mix", lambda x, seed=0: np.zeros_like(x) if seed == 61 else real(x, seed))
    p = pm.Pieces(data, np.array([0, 8]))
    assert p.word[0] == p.word[2] != p.word[1] and [p.names[int(i)].as_py() for i in p.word] == ["ab", "cd", "ab"]
