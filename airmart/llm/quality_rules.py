"""Line-first quality cleaning.

Every line is judged by itself with three rules (punctuation, navigation, boilerplate). Failing lines are
removed; a document is then rejected when the removed lines hold more than ``MAX_LOST`` of its words.
Document-level base limits (length, repeated three-word windows) are reported beside the verdict.

Edge cases: a null or empty text has no words, so all counts are 0, ``base_failed`` is true and ``kept``
false. Repeated rows and null ids are judged like any other row (one result row per input row, in a pure map
without shuffle). Other columns are passed through or not looked at, whatever their names; an empty table
gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._words import Words, grams, slices

MIN_WORDS = 50          # shorter documents fail the base check
MAX_REPEAT_PCT = 50     # per cent of words inside repeated three-word windows
MAX_LOST = 0.5          # share of words that the line rules may remove
NAV_SHARE = 0.2         # separators among the tokens of a navigation line
MARK_SHARE = 0.3        # words ending in a run of symbols in a badly punctuated line
LONG_UNPUNCTUATED = 60  # words from which a line must hold some sentence punctuation
BOILERPLATE_WORDS = 25  # boilerplate phrases condemn lines up to this length only

# Separators of navigation bars; phrases of page furniture and licence lines.
NAV_TOKENS = frozenset(x.encode() for x in ("|", ">", ">>", "/", "·", "•", "»", "→"))
BOILERPLATE = re.compile(
    rb"all rights reserved|copyright|licensed under|terms of (?:use|service)|privacy policy|cookies?\b|javascript"
    rb"|lorem ipsum|click here|read more|sign up|log ?in\b|subscribe|share this|skip to (?:main )?content",
    re.IGNORECASE)
_MARKS = re.compile(rb"(?:[#*$%&|<>~^=_+@{}!?]){2,}[.,;:]?$")
_MARK = re.compile(rb"[#*$%&|<>~^=_+@{}!?]{2}")
_SENTENCE = re.compile("[.!?:;,]|…|。|！|？|，".encode())
_LETTER = re.compile(rb"[A-Za-z\xc3-\xf4]")

REPORT = T.StructType([T.StructField(n, T.LongType()) for n in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines", "n_lost_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])


def line_verdict(line: bytes, words: list[bytes]) -> str | None:
    """The rule that a line with words breaks, or None: ``punctuation``, ``navigation`` or ``boilerplate``."""
    n = len(words)
    if n >= 3 and sum(w in NAV_TOKENS for w in words) >= NAV_SHARE * n:
        return "navigation"
    if n <= BOILERPLATE_WORDS and BOILERPLATE.search(line):
        return "boilerplate"
    if not _LETTER.search(line) or n >= LONG_UNPUNCTUATED and not _SENTENCE.search(line):
        return "punctuation"
    if n >= 3 and _MARK.search(line) and sum(1 for w in words if _MARKS.search(w)) > MARK_SHARE * n:
        return "punctuation"
    return None


def judge_lines(text: bytes) -> tuple[list[bytes], int, int, int]:
    """(lines that stay, lines removed, words removed, repeated lines) of a text; lines without words stay."""
    stay, failed, lost, repeats, seen = [], 0, 0, 0, set()
    for line in text.split(b"\n"):
        words = line.split()
        if words:
            repeats += line in seen
            seen.add(line)
            if line_verdict(line, words):
                failed += 1
                lost += len(words)
                continue
        stay.append(line)
    return stay, failed, lost, repeats


def _repeat_words(h: np.ndarray) -> int:
    """Words of one text covered by three-word windows that it holds twice or more."""
    g = grams(h, 3)
    if len(g) < 2:
        return 0
    _, inverse, counts = np.unique(g, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(h), dtype=bool)
    for j in range(3):
        covered[j:j + len(again)] |= again
    return int(covered.sum())


def _judge(part: pa.RecordBatch, data: np.ndarray, off: np.ndarray) -> tuple[dict[str, list], list[bytes]]:
    w = Words(data, off)
    h, raw = w.hashes(), data.tobytes()
    codepoints = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    space = np.isin(data, np.frombuffer(b" \t\n\r\x0b\x0c", dtype=np.uint8))
    symbol = np.isin(data, np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
    spaces, symbols = (np.concatenate(([0], np.cumsum(x))) for x in (space, symbol))
    out: dict[str, list] = {f.name: [] for f in REPORT}
    texts = []
    for i in range(len(off) - 1):
        a, b = int(off[i]), int(off[i + 1])
        n = int(w.first[i + 1] - w.first[i])
        stay, failed, lost, dups = judge_lines(raw[a:b])
        repeat = _repeat_words(h[w.first[i]:w.first[i + 1]])
        base_failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PCT * n
        for name, value in (("n_words", n), ("word_chars", int(codepoints[b] - codepoints[a] - spaces[b] + spaces[a])),
                            ("n_symbols", int(symbols[b] - symbols[a])), ("n_dup_lines", dups),
                            ("n_repeat_words", repeat), ("n_failed_lines", failed), ("n_lost_words", lost),
                            ("base_failed", base_failed), ("kept", not base_failed and lost <= MAX_LOST * n)):
            out[name].append(value)
        texts.append(b"\n".join(stay))
    return out, texts


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, base counts, removed lines and words, ``base_failed`` and ``kept``."""
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    out = T.StructType([T.StructField(id_col, src.schema["_id"].dataType), *REPORT.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "_text"):
                cols, _ = _judge(part, data, off)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(cols[f.name]) for f in REPORT)], names=out.names)

    return src.mapInArrow(run, out)


def clean_documents(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The accepted documents with all their columns: failing lines are gone from the text, and
    ``chars_col`` (if there is one) is the length of what is left."""
    names, schema = docs.columns, docs.schema
    has_chars = chars_col in names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, text_col):
                cols, texts = _judge(part, data, off)
                keep = np.asarray(cols["kept"], dtype=bool)
                text = pa.array([t.decode() for t, k in zip(texts, keep) if k], type=part.schema.field(text_col).type)
                rows = part.filter(pa.array(keep))
                new = {text_col: text}
                if has_chars:
                    new[chars_col] = pa.compute.cast(pa.compute.utf8_length(text), rows.schema.field(chars_col).type)
                yield pa.RecordBatch.from_arrays([new.get(n, rows.column(i)) for i, n in enumerate(names)], names=names)

    return docs.mapInArrow(run, schema)
