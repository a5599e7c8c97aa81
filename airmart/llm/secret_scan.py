"""Secret scan with multipart credential linking.

Strong findings stand alone: assignments to a secret-like key (``assign``), access key ids (``access``) and
long hex strings (``hex``). Weak parts are reported only when complementary parts co-occur: labelled access
identifiers (``id``), random-looking tokens (``token``) and endpoints (``endpoint``) are joined on their
position intervals within a scope, and a token is reported when an identifier or an endpoint lies within
``SCOPE_CHARS`` code points of it in the same paragraph, and every identifier and endpoint when a secret does.
Strong findings count as partners too. The interval join runs over sorted positions, from each side to its
nearest of the other, so a text with many parts costs n log n.

Edge cases: a null or empty text has no findings (counts 0, empty span string, the SHA-256 of the empty
string). Repeated rows, null ids and other columns (whatever their names) change nothing: it is a pure map
over the rows. Texts of any length are scanned whole. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._tables import schema
from ._words import Words, slices

# The three strong patterns and their order.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
_ASSIGN_KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# Weak parts.
SCOPE_CHARS = 300
MIN_TOKEN, MIN_ENTROPY = 16, 3.0
IDENT = re.compile(r"""(?i:\b(?:access_?(?:key)?_?id|client_?id|user(?:name|_id)?|login|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]{3,})""", re.ASCII)
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=.@-])[A-Za-z0-9+/_=.-]{%d,}(?![A-Za-z0-9+/_=.@-])" % MIN_TOKEN, re.ASCII)
ENDPOINT = re.compile(r"""[A-Za-z][A-Za-z0-9+.-]*://[^\s"'<>]+|\b[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+:[0-9]{2,5}\b""", re.ASCII)
PARAGRAPH = re.compile(r"\n[ \t\r]*\n")

OUTPUT = schema("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long")


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values())


def strong_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the findings that stand alone, by start and then kind as listed."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def _near(spans: list[tuple[int, int, str]], others: list[tuple[int, int, str]], breaks: list[int]) -> list[list[int]]:
    """Interval join: for each span the indexes of its nearest neighbours among ``others`` (sorted) on either
    side, if they lie within ``SCOPE_CHARS`` and no paragraph border is between."""
    starts = [o[0] for o in others]
    last = list(accumulate(range(len(others)), lambda i, j: max(i, j, key=lambda k: others[k][1])))  # of those up to each, what ends last
    found = []
    for a, b, _ in spans:
        i = bisect_right(starts, a)
        hits = []
        for j in (*last[max(i - 1, 0):i], i):
            if j < len(others):
                x, y, _ = others[j]
                gap_lo, gap_hi = (y, a) if x <= a else (b, x)
                if gap_hi - gap_lo <= SCOPE_CHARS and bisect_left(breaks, gap_lo) == bisect_left(breaks, max(gap_lo, gap_hi)):
                    hits.append(j)
        found.append(hits)
    return found


def linked_spans(text: str, strong: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Weak parts that are reported because complementary parts co-occur in their scope."""
    taken = [(a, b) for a, b, _ in strong]
    clear = lambda a, b: not any(x < b and a < y for x, y in taken[max(0, bisect_left(taken, (a, 0)) - 2):bisect_right(taken, (b, b))])
    endpoints = [(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)]
    idents = [(m.start(), m.end(), "id") for m in IDENT.finditer(text) if clear(m.start(), m.end())]
    inside = sorted((a, b) for a, b, _ in endpoints + idents)
    tokens = []
    for m in TOKEN.finditer(text):
        a, b = m.span()
        i = bisect_right(inside, (a, len(text) + 1)) - 1
        covered = i >= 0 and inside[i][1] > a
        s = m[0]
        if not covered and clear(a, b) and any(c.isdigit() for c in s) and any(c.isalpha() for c in s) and _entropy(s) >= MIN_ENTROPY:
            tokens.append((a, b, "token"))
    secrets = sorted(tokens + [x for x in strong if x[2] in ("assign", "hex")])
    keys = sorted(idents + [x for x in strong if x[2] == "access"])
    if not secrets or not (keys or endpoints):
        return []
    breaks = [m.start() for m in PARAGRAPH.finditer(text)]
    out = set()
    for role in (keys, endpoints):
        if role:
            for spans, others in ((secrets, role), (role, secrets)):
                out.update(x for x, hits in zip(spans, _near(spans, others, breaks)) if hits and x[2] in ("id", "token", "endpoint"))
    return sorted(out)


def _join(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _candidates(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rows of a slice that can hold any finding: a key word, ``AKIA``, a long hex run or a long word with a digit."""
    raw = data.tobytes()
    low = raw.lower()
    rows = np.zeros(len(off) - 1, dtype=bool)
    for text, keys in ((low, _ASSIGN_KEYS), (raw, (b"AKIA",))):
        for key in keys:
            at = text.find(key)
            while at >= 0:
                r = int(np.searchsorted(off, at, side="right")) - 1
                rows[r] = True
                at = text.find(key, max(at + 1, int(off[r + 1]) - len(key) + 1))
    digit = np.concatenate(([0], np.cumsum((data >= 48) & (data <= 57))))
    w = Words(data, off)
    long = (w.end - w.start >= MIN_TOKEN) & (digit[w.end] > digit[w.start])
    rows[w.doc[long]] = True
    run = np.concatenate(([0], ((data >= 48) & (data <= 57) | (data >= 97) & (data <= 102)).view(np.int8), [0]))
    edge = np.diff(run)
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    rows[np.searchsorted(off, a[b - a >= MIN_HEX], side="right") - 1] = True
    return rows


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of strong findings, digest of their spans, all spans, weak parts linked."""
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    out = T.StructType([T.StructField(id_col, src.schema["_id"].dataType), *OUTPUT.fields])
    nothing = (0, 0, 0, hashlib.sha256(b"").hexdigest(), "", 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "_text"):
                rows = [nothing] * len(part)
                for i in np.flatnonzero(_candidates(data, off)):
                    text = data[off[i]:off[i + 1]].tobytes().decode()
                    strong = strong_spans(text)
                    weak = linked_spans(text, strong)
                    count = Counter(k for _, _, k in strong)
                    merged = sorted(strong + weak, key=lambda x: (x[0], (*KINDS, "id", "token", "endpoint").index(x[2])))
                    rows[i] = (*(count[k] for k in KINDS), hashlib.sha256(_join(strong).encode()).hexdigest(), _join(merged), len(weak))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array([r[j] for r in rows], type=pa.string() if j in (3, 4) else pa.int64()) for j in range(6))],
                    names=out.names)

    return src.mapInArrow(run, out)
