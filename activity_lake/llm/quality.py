"""Quality rules as a short-circuit cascade.

Each rule is a predicate over a text's features; a text is rejected if any rule fails
it. On a bounded sample `plan` measures each rule's cost (seconds a text) and selectivity
(share of texts it rejects) and orders the rules by rejections per cost; `judge` and
`keep` then evaluate them in that order, and a text that a rule rejected isn't shown to
later ones. The order changes the work, never the verdict, since a text is kept exactly
if all rules pass it.

Defined cases: a null text counts as empty; a text without words fails MIN_WORDS; bytes
are never decoded (a code point is a byte that doesn't continue another); the order falls
back to the given one on an empty sample; repeated rows are judged alike; an empty table
gives an empty result; `keep` passes all input columns through untouched.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as X
from ._spark import text_bytes, tidy

#: The sample on which costs and selectivities are estimated (expected rows, drawn by hash), and
#: most bytes of a text in it; only the order of rules depends on the sample.
SAMPLE_ROWS = 400
SAMPLE_TEXT_BYTES = 64 << 10

#: Thresholds of the rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 50      # symbols for 100 words
MAX_DUP_LINE_PERCENT = 50    # duplicate lines for 100 lines with a word
MAX_CAPS_PERCENT = 60        # A-Z for 100 ASCII letters
MAX_BAR_PERCENT = 20         # words that are a lone | for 100 words
MAX_MEAN_WORD_CHARS = 40

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True


class Text:
    """One text's bytes; features are computed when a rule first asks for them."""

    def __init__(self, data: bytes):
        self.data = data
        self.buf = np.frombuffer(data, np.uint8)
        self._have: dict[str, int] = {}
        self._words: X.Words | None = None

    def _get(self, name: str, make: Callable[[], int]) -> int:
        if name not in self._have:
            self._have[name] = int(make())
        return self._have[name]

    @property
    def n_words(self) -> int:
        return self._get("n_words", lambda: len(self.data.split()))

    @property
    def word_chars(self) -> int:
        return self._get("word_chars", lambda: np.count_nonzero(~X.SPACE[self.buf] & ((self.buf & 0xC0) != 0x80)))

    @property
    def n_symbols(self) -> int:
        return self._get("n_symbols", lambda: np.count_nonzero(_SYMBOL[self.buf]))

    @property
    def n_bars(self) -> int:
        return self._get("n_bars", lambda: self.data.split().count(b"|"))

    @property
    def n_upper(self) -> int:
        return self._get("n_upper", lambda: np.count_nonzero(_UPPER[self.buf]))

    @property
    def n_letters(self) -> int:
        return self._get("n_letters", lambda: np.count_nonzero(_LETTER[self.buf]))

    def _lines(self) -> list[bytes]:
        return [x for x in self.data.split(b"\n") if x.split(None, 1)]

    @property
    def n_lines(self) -> int:
        return self._get("n_lines", lambda: len(self._lines()))

    @property
    def n_dup_lines(self) -> int:
        """Lines with a word that equal an earlier line."""
        def make():
            lines = self._lines()
            return len(lines) - len(set(lines))
        return self._get("n_dup_lines", make)

    @property
    def n_repeat_words(self) -> int:
        """Words in a window of three words that the text holds twice or more."""
        def make():
            code = X.words(self.buf, np.array([0, len(self.buf)]), fold=X.AS_IS).codes()[0]
            if len(code) < 4:
                return 0
            window = X.window_codes(code, 3)
            twice = np.bincount(window)[window] > 1
            hit = np.zeros(len(code), bool)
            for k in range(3):
                hit[k:len(window) + k] |= twice
            return np.count_nonzero(hit)
        return self._get("n_repeat_words", make)


@dataclass(frozen=True)
class Rule:
    """rejects(text) is true for a text that fails the rule."""

    name: str
    rejects: Callable[[Text], bool]


RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda t: t.n_words < MIN_WORDS),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > MAX_REPEAT_PERCENT * t.n_words),
    Rule("symbols", lambda t: 100 * t.n_symbols > MAX_SYMBOL_PERCENT * t.n_words),
    Rule("duplicate_lines", lambda t: 100 * t.n_dup_lines > MAX_DUP_LINE_PERCENT * t.n_lines),
    Rule("capitals", lambda t: 100 * t.n_upper > MAX_CAPS_PERCENT * t.n_letters),
    Rule("bars", lambda t: 100 * t.n_bars > MAX_BAR_PERCENT * t.n_words),
    Rule("long_words", lambda t: t.word_chars > MAX_MEAN_WORD_CHARS * t.n_words),
)


@dataclass(frozen=True)
class Measured:
    """A rule's estimate from the sample, in the order of the cascade."""

    name: str
    cost_s: float
    rejected: float


def plan(texts: list[bytes], rules: tuple[Rule, ...] = RULES) -> list[Measured]:
    """Rules by rejections per cost, best first, given those already placed.

    Rejections overlap, so the selectivity of the next rule is taken among the texts
    that the rules before it leave; costs are measured on fresh texts."""
    cost, fails = {}, {}
    for rule in rules:
        fresh = [Text(x) for x in texts]
        began = time.perf_counter()
        fails[rule.name] = np.array([rule.rejects(t) for t in fresh], bool)
        cost[rule.name] = max((time.perf_counter() - began) / max(len(texts), 1), 1e-9)
    left, out, alive = [r.name for r in rules], [], np.ones(len(texts), bool)
    while left:
        share = {n: float(fails[n][alive].mean()) if alive.any() else 0.0 for n in left}
        best = max(left, key=lambda n: share[n] / cost[n])
        out.append(Measured(best, cost[best], share[best]))
        alive &= ~fails[best]
        left.remove(best)
    return out


def cascade(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", rules: tuple[Rule, ...] = RULES,
            sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules in the order estimated on a bounded sample of docs."""
    share = min(1.0, sample_rows / max(docs.count(), 1))
    below = min(-2**63 + int(share * 2**64), 2**63 - 1)
    draw = docs.where(F.xxhash64(F.col(id_col).cast("string")) <= below).select(
        F.substring(text_bytes(docs, text_col), 1, SAMPLE_TEXT_BYTES).alias("text"))
    # About sample_rows texts in all; the limit holds if many rows share a drawn id.
    sample = [r[0] or b"" for r in draw.limit(2 * sample_rows).collect()]
    by_name = {r.name: r for r in rules}
    return [by_name[m.name] for m in plan(sample, rules)]


def first_failure(text: Text, ordered: list[Rule]) -> str | None:
    """The first rule of the cascade that rejects the text; later ones aren't evaluated."""
    return next((r.name for r in ordered if r.rejects(text)), None)


def keep(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", rules: tuple[Rule, ...] = RULES,
         sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs that pass all rules, all columns unchanged."""
    ordered = cascade(docs, text_col, id_col, rules, sample_rows)
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = X.binary(batch.column(place).cast(pa.large_string()))
            ok = [first_failure(Text(x.as_py()), ordered) is None for x in texts]
            yield batch.filter(pa.array(ok, pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)


def judge(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", rules: tuple[Rule, ...] = RULES,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """id, the base features, failed_rule (null: none) and kept of every row."""
    ordered = cascade(docs, text_col, id_col, rules, sample_rows)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    src = docs.select(F.col(id_col).alias("id"), text_bytes(docs, text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {n: [] for n in names}
            failed = []
            for data in X.binary(batch.column("text")):
                t = Text(data.as_py())
                failed.append(first_failure(t, ordered))
                for n in names:
                    out[n].append(getattr(t, n))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(out[n], pa.int64()) for n in names), pa.array(failed, pa.string()),
                 pa.array([f is None for f in failed], pa.bool_())], names=["id", *names, "failed_rule", "kept"])

    return src.mapInArrow(tidy(run), f"id {kind}, " + ", ".join(f"{n} long" for n in names) + ", failed_rule string, kept boolean")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, i, ws[i] || chr(1) || ws[i + 1] || chr(1) || ws[i + 2] AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM w),
h AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
f AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(l.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(h.n, 0) AS BIGINT) AS n_repeat_words,
             coalesce(l.n_lines, 0) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
             length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters, len(list_filter(ws, lambda x: x = '|')) AS n_bars
      FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN l ON l.doc_id = d.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 50 * n_words
            OR 100 * n_dup_lines > 50 * n_lines OR 100 * n_upper > 60 * n_letters OR 100 * n_bars > 20 * n_words
            OR word_chars > 40 * n_words) AS kept
FROM f
"""
