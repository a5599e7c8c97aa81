"""License scan by ordered signature rules.

A text's words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z) are joined by single spaces. One pass
over them collects which keywords occur; the rules of ``license_rules`` whose keywords are there are tried, in their
order. Of overlapping detections those that lie inside another one of the same or a higher priority (of equal
intervals: of the same priority, the earlier rule's) are suppressed. Detections of the base phrases always stay.

Scale: a pure map over whole texts; a task holds a slice of about 1 MB (one text is never split) and the detections
of one text. Keywords are found by one automaton for all rules; suppression sorts a text's detections.

Edge cases: a null or empty text has no words and no detections; its labels are empty strings, its places null,
its score 0. Rows with equal or null ids are scanned one by one. Other columns are not read. An empty table gives
an empty one.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import schema
from ._words import slices
from .license_rules import Rule, build_rules

#: Bytes of words; A-Z become a-z, all others a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
Detection = tuple[int, int, int]  # first word, end word, number of the rule


@cache
def rule_set() -> tuple[list[Rule], ahocorasick.Automaton]:
    """The rules and the automaton of their keywords (built once per worker)."""
    rules, words = build_rules(), ahocorasick.Automaton()
    for word in sorted({w for r in rules for gate in r.gates for w in gate}):
        words.add_word(word, word)
    words.make_automaton()
    return rules, words


@cache
def _open_rules(found: frozenset[str]) -> tuple[int, ...]:
    return tuple(i for i, r in enumerate(rule_set()[0]) if all(gate & found for gate in r.gates))


def candidates(norm: bytes) -> tuple[int, ...]:
    """Numbers of the rules whose keywords all occur in the normalised words."""
    return _open_rules(frozenset(word for _, word in rule_set()[1].iter(norm.decode("latin-1"))))


def detect(norm: bytes) -> list[Detection]:
    """All places of all rules that are tried, as intervals of words."""
    tried = candidates(norm)
    if not tried:
        return []
    rules, out = rule_set()[0], []
    gaps = np.flatnonzero(np.frombuffer(norm, dtype=np.uint8) == 32)
    for i in tried:
        at = [m.span() for m in rules[i].pattern.finditer(norm)]
        if at:
            first = np.searchsorted(gaps, [a for a, _ in at])
            end = np.searchsorted(gaps, [b for _, b in at]) + 1
            out += [(a, b, i) for a, b in zip(first.tolist(), end.tolist())]
    return out


def suppress(found: list[Detection]) -> list[Detection]:
    """The detections that stay: base ones, and those inside no other one of the same or a higher priority."""
    rules = rule_set()[0]
    kept: list[Detection] = []
    starts: list[int] = []     # of the outermost intervals of the priorities so far, by start; their ends rise too
    ends: list[int] = []
    rank = lambda d: (rules[d[2]].priority, d[0], -d[1], d[2])
    for _, level in groupby(sorted(found, key=rank), key=lambda d: rules[d[2]].priority):
        for a, b, i in level:
            k = bisect_right(starts, a)
            inside = k > 0 and ends[k - 1] >= b
            if rules[i].base or not inside:
                kept.append((a, b, i))
            if not inside:
                lo = bisect_left(starts, a)
                hi = bisect_right(ends, b)
                del starts[lo:hi], ends[lo:hi]  # those inside this one
                insort(starts, a)
                insort(ends, b)
    return kept


def _scans(docs: DataFrame, id_col: str, text_col: str, out, make) -> DataFrame:
    """``make(id array, [(normalised words, their number, detections that stay)])`` -> arrays, over slices of texts."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "text"):
                raw = data.tobytes().translate(_FOLD)
                rows = []
                for a, b in zip(off[:-1], off[1:]):
                    words = raw[a:b].split(b" ")
                    norm = b" ".join(w for w in words if w)
                    rows.append((norm.count(b" ") + 1 if norm else 0, suppress(detect(norm))))
                yield pa.RecordBatch.from_arrays(make(part.column(0), rows), schema=_arrow(out))

    return src.mapInArrow(run, out)


def _arrow(out) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in out.fields])


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per detection that stays: id, ``label``, ``kind``, ``priority``, ``relevance``, ``first_word``, ``end_word``."""
    out = schema("id long, label string, kind string, priority long, relevance double, first_word long, end_word long")

    def make(ids, rows):
        rules = rule_set()[0]
        each = [(i, rules[r], a, b) for i, (_, found) in enumerate(rows) for a, b, r in sorted(found)]
        return [ids.take(pa.array([i for i, *_ in each], type=pa.int64())), *(pa.array(list(x), type=t) for x, t in (
            ((r.label for _, r, _, _ in each), pa.string()), ((r.kind for _, r, _, _ in each), pa.string()),
            ((r.priority for _, r, _, _ in each), pa.int64()), ((r.relevance for _, r, _, _ in each), pa.float64()),
            ((a for _, _, a, _ in each), pa.int64()), ((b for _, _, _, b in each), pa.int64())))]

    return _scans(docs, id_col, text_col, out, make).withColumnRenamed("id", id_col)


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and ``last_word`` of these
    places, ``base_labels``, ``labels`` (all that stay), ``score`` (the relevance of the strongest detection that stays; more
    distinct labels do not add up) and ``n_detections``."""
    out = schema("id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_detections long")

    def make(ids, rows):
        rules, cols = rule_set()[0], [[] for _ in out.names[1:]]
        for n, found in rows:
            base = [a for a, _, r in found if rules[r].base]
            values = (n, len(base), min(base, default=None), max(base, default=None), ",".join(sorted({rules[r].label for _, _, r in found if rules[r].base})),
                      ",".join(sorted({rules[r].label for _, _, r in found})), max((rules[r].relevance for _, _, r in found), default=0.0), len(found))
            for col, value in zip(cols, values):
                col.append(value)
        return [ids, *(pa.array(c, type=f.type) for c, f in zip(cols, list(_arrow(out))[1:]))]

    return _scans(docs, id_col, text_col, out, make).withColumnRenamed("id", id_col)
