"""Plain Python versions of the operators, written from their definitions."""

import collections
import hashlib
import math
import re
import zlib

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(text, lower=False):
    raw = (text or "").encode()
    return (raw.translate(LOWER) if lower else raw).split()


def shingle_set(text, n):
    w = words(text, True)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(docs, n=4, percent=85):
    """{doc_id: (set size, smallest reachable id)}"""
    sets = {i: shingle_set(t, n) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def substring_dedup(docs, size=13):
    """{doc_id: (words, removed, sha256 of the kept words)}"""
    first = {}
    for i, t in docs:
        w = words(t)
        for j in range(len(w) - size + 1):
            k = tuple(w[j:j + size])
            first[k] = min(i, first.get(k, i))
    out = {}
    for i, t in docs:
        w = words(t)
        gone = set()
        for j in range(len(w) - size + 1):
            if first[tuple(w[j:j + size])] < i:
                gone.update(range(j, j + size))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def quality_base(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    w = [x.decode() for x in words(text)]
    tri = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    rep = {i + k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in range(3)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if words(line):
            dups += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dups, len(rep)


def secret_base(text):
    """[(kind, start, end)] by start, then kind as listed."""
    text, out = text or "", []
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer("(" + key + ")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def katz(docs, top=5, least=1):
    """{doc_id: (held, tokens, known, train tokens, base score, score)} and the conditional probabilities."""
    toks = {i: words(t, True) + [None] for i, t in docs}
    train = [i for i in toks if zlib.crc32(str(i).encode()) % 7 != 2]
    c = collections.Counter(w for i in train for w in toks[i])
    total, types = sum(c.values()), len(c)
    b = collections.Counter(p for i in train for p in zip(["<s>"] + toks[i], toks[i]))

    def discount(counts):
        n = collections.Counter(counts.values())
        mu = (top + 1) * n[top + 1] / n[1] if n[1] else 1
        d = {}
        for r in range(1, top + 1):
            x = ((r + 1) * n[r + 1] / n[r] / r - mu) / (1 - mu) if n[r] and n[r + 1] and mu != 1 else -1
            d[r] = x if 0 < x < 1 else (r - 0.5) / r
        return lambda r: d.get(r, 1.0)
    d1, d2 = discount(c), discount(b)
    seen = sum(d1(x) * x for x in c.values()) / total if total else 0
    most = 1 - 0.5 / (total + 1) if total else 0
    scale = most / seen if seen > most else 1
    unknown = 1 - min(seen, most)
    prob = lambda w: scale * d1(c[w]) * c[w] / total if w in c else unknown
    of = collections.Counter()
    follow = collections.defaultdict(list)
    for (h, w), x in b.items():
        of[h] += x
        if x >= least:
            follow[h].append((w, x))
    alpha, fit = {}, {}
    for h, ws in follow.items():
        s, m = sum(d2(x) * x for _, x in ws) / of[h], 1 - 0.5 / of[h]
        fit[h] = m / s if s > m else 1
        alpha[h] = (1 - min(s, m)) / (1 - sum(prob(w) for w, _ in ws))

    def cond(h, w):
        x = b.get((h, w), 0)
        return fit[h] * d2(x) * x / of[h] if x >= least else alpha.get(h, 1.0) * prob(w)
    for h in [*list(follow)[::len(follow) // 100 + 1], "never seen"]:  # histories sum to one (a hundred of them: each takes all words)
        assert abs(sum(cond(h, w) for w in c) + alpha.get(h, 1.0) * unknown - 1) < 1e-9 or not c
    base = lambda w: math.log10((c[w] + 1) / (total + types + 1))
    return {i: (i not in train, len(t), sum(w in c for w in t), total, sum(map(base, t)),
                sum(math.log10(cond(h, w)) for h, w in zip(["<s>"] + t, t))) for i, t in toks.items()}


def edit_distance(item, text):
    """Least word edits between the item and any run of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def folded(text):
    return re.sub(r"[!-/:-@\[-`{-~]", " ", text or "").encode().translate(LOWER).split()


def contaminated(docs, items, share=0.2):
    """{(doc_id, item_id): distance}"""
    out = {}
    for k, t in items:
        it = folded(t)
        for i, x in docs:
            if it:
                d = edit_distance(it, folded(x))
                if d <= int(share * len(it) + 1e-9):
                    out[i, k] = d
    return out
