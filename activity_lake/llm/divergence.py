"""Source divergence audit: which terms set a source apart from its language's others.

Terms are counted in tasks by length-bucketed packing. A term of at most 8 bytes is one
big-endian uint64, one of at most 16 bytes two of them (a term holds no zero byte, so
padding is unambiguous); rows (term, group, document) are radix-sorted by 16-bit digits in
NumPy and their runs counted. Longer terms go to buckets by their length and are sorted
there as byte strings. A task hands on one row a group and term with its occurrences and
documents; Spark sums them by (language, source, term).

A language keeps the terms of at least MIN_DOCS of its documents. Sources are compared on
blocks of kept terms and tiles of sources, so that no group holds a whole language; terms
that both of two sources lack are accounted for by their number. All arithmetic is exact.

Defined cases: null text, language and source count as ''; a group without terms, and a
language without kept terms, still has its pairs (value 0 without kept terms); ties rank by
the item's UTF-8 bytes; repeated rows are documents each; ids aren't read; bytes that aren't
UTF-8 count as parts of terms and come back as the replacement character; a text of any
length is counted whole, in about thirty bytes of working memory a byte; an empty table gives
an empty result; other input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _text as X
from ._spark import stored, text_bytes

MIN_DOCS = 30
TOP_TERMS = 50
#: p = 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V)).
SCALE, PRIOR = 1_000_000_000, 5
#: Kept terms of a block and sources of a tile when sources are compared.
BLOCK_TERMS, TILE = 4096, 256
#: A task hands its counts on when it holds so many (group, term) rows.
FLUSH = 2_000_000

#: Terms are runs of ASCII letters and of all bytes beyond ASCII.
_APART = np.ones(256, bool)
_APART[65:91] = _APART[97:123] = _APART[128:] = False


def radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows by uint64 columns, first column most significant: least
    significant digit first, 16 bits a pass; digits that all rows share are skipped."""
    order = np.arange(len(columns[0]))
    for column in reversed(columns):
        top = int(column.max()) if len(column) else 0
        for shift in range(0, max(top.bit_length(), 1), 16):
            digit = (column >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def packed(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: int) -> list[np.ndarray]:
    """Spans of at most 8 * words bytes as big-endian uint64 columns, padded with zeros."""
    lanes, size = X._lanes(folded), ends - starts
    out = []
    for k in range(words):
        left = np.clip(size - 8 * k, 0, 8)
        lane = lanes[np.minimum(starts + 8 * k, len(folded))] & X._MASK[left]
        out.append(lane.astype("<u8").byteswap())
    return out


def unpacked(columns: list[np.ndarray]) -> list[bytes]:
    """The terms of packed columns."""
    raw = np.stack([c.astype("<u8").byteswap() for c in columns], axis=1).astype("<u8").tobytes()
    width = 8 * len(columns)
    return [raw[i:i + width].rstrip(b"\0") for i in range(0, len(raw), width)]


def _runs(columns: list[np.ndarray]) -> np.ndarray:
    """First row of each run of equal rows."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _count_short(columns: list[np.ndarray], group: np.ndarray, doc: np.ndarray) -> tuple:
    """(term columns, group, occurrences, documents) of the runs of (term, group)."""
    order = radix_order([*columns, group])    # stable: documents stay in order within a run
    columns, group, doc = [c[order] for c in columns], group[order], doc[order]
    at = _runs([*columns, group])
    fresh = np.ones(len(doc), np.int64)
    fresh[1:] = doc[1:] != doc[:-1]
    fresh[at] = 1
    return [c[at] for c in columns], group[at], np.diff(np.append(at, len(doc))), np.add.reduceat(fresh, at)


def _count_long(terms: list[bytes], group: np.ndarray, doc: np.ndarray) -> list[tuple]:
    """(term, group, occurrences, documents) of one length's terms, sorted as byte strings."""
    out: list[list] = []
    last = None
    for term, g, d in sorted(zip(terms, group.tolist(), doc.tolist())):
        if last is None or last[:2] != (term, g):
            out.append([term, g, 0, 0])
            last = (term, g, None)
        out[-1][2] += 1
        out[-1][3] += last[2] != d
        last = (term, g, d)
    return [tuple(x) for x in out]


class Counter:
    """Counts of (group, term) of the blocks that a task has seen."""

    def __init__(self):
        self.short: dict[int, list[tuple]] = {1: [], 2: []}
        self.long: dict[tuple, list[int]] = {}
        self.rows = 0

    def add(self, buf: np.ndarray, offs: np.ndarray, group: np.ndarray) -> None:
        """Terms of a block of texts; group is the number of each text's group."""
        if not len(buf):
            return
        starts, ends = X.spans(~_APART[buf], offs)
        doc = np.searchsorted(offs, starts, side="right") - 1
        folded, size = X.LOWER[buf], ends - starts
        for words in (1, 2):
            at = np.flatnonzero((size > 8 * (words - 1)) & (size <= 8 * words))
            if len(at):
                part = _count_short(packed(folded, starts[at], ends[at], words), group[doc[at]].astype(np.uint64), doc[at])
                self.short[words].append(part)
                self.rows += len(part[1])
        for n in np.unique(size[size > 16]):
            at = np.flatnonzero(size == n)
            terms = [folded[starts[i]:ends[i]].tobytes() for i in at]
            for term, g, k, d in _count_long(terms, group[doc[at]], doc[at]):
                held = self.long.setdefault((term, g), [0, 0])
                held[0] += k
                held[1] += d
                self.rows += len(term) // 8

    def flush(self) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """(terms, group, occurrences, documents), then empty."""
        terms: list[bytes] = []
        group, count, docs = [], [], []
        for words, parts in self.short.items():
            if not parts:
                continue
            columns = [np.concatenate([p[0][k] for p in parts]) for k in range(words)]
            g, n, d = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
            order = radix_order([*columns, g])
            columns, g = [c[order] for c in columns], g[order]
            at = _runs([*columns, g])
            terms += unpacked([c[at] for c in columns])
            group.append(g[at].astype(np.int64))
            count.append(np.add.reduceat(n[order], at))
            docs.append(np.add.reduceat(d[order], at))
        if self.long:
            terms += [t for t, _ in self.long]
            group.append(np.array([g for _, g in self.long], np.int64))
            count.append(np.array([v[0] for v in self.long.values()], np.int64))
            docs.append(np.array([v[1] for v in self.long.values()], np.int64))
        self.__init__()
        none = [np.zeros(0, np.int64)]
        return terms, *(np.concatenate(x or none) for x in (group, count, docs))


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold the term) of every
    (language, source) group; one row with a null term, and all its documents, for each group."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    src = docs.select(some(lang_col).alias("lang"), some(source_col).alias("source"), text_bytes(docs, text_col).alias("text"))

    def run(batches):
        names: dict[tuple[str, str], int] = {}
        seen: list[int] = []
        counter = Counter()

        def rows():
            terms, group, n, d = counter.flush()
            keys = list(names)
            terms = [t.decode("utf-8", "replace") for t in terms] + [None] * len(keys)
            at = np.concatenate((group, np.arange(len(keys))))
            n, d = np.concatenate((n, np.zeros(len(keys), np.int64))), np.concatenate((d, np.array(seen, np.int64)))
            names.clear()
            seen.clear()
            for lo in range(0, len(terms), 100_000):
                part = at[lo:lo + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[i][0] for i in part], pa.string()), pa.array([keys[i][1] for i in part], pa.string()),
                     pa.array(terms[lo:lo + 100_000], pa.string()), pa.array(n[lo:lo + 100_000]), pa.array(d[lo:lo + 100_000])],
                    names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for at, buf, offs in X.blocks(batch.column("text")):
                n = len(offs) - 1
                group = np.empty(n, np.int64)
                for i, key in enumerate(zip(langs[at:at + n], sources[at:at + n])):
                    group[i] = names.setdefault(key, len(names))
                    if group[i] == len(seen):
                        seen.append(0)
                    seen[group[i]] += 1
                counter.add(buf, offs, group)
                if counter.rows >= FLUSH:
                    yield from rows()
        yield from rows()

    parts = src.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a term, exactly: counts are widened before they are scaled."""
    wide = lambda c, n: c.cast(f"decimal({n},0)")
    up, down = wide(count + F.lit(PRIOR), 19) * wide(F.lit(SCALE), 10), wide(total + F.lit(PRIOR) * kept, 19)
    return F.call_function("div", up, down) + F.lit(1)


def _shares(n: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """The same in NumPy; counts near the 64-bit limit are scaled as Python integers."""
    if len(n) and int(n.max()) >= (1 << 62) // SCALE:
        return (1 + (SCALE * (n.astype(object) + PRIOR)) // (total.astype(object) + PRIOR * kept)).astype(np.int64)
    return 1 + SCALE * (n + PRIOR) // (total + PRIOR * kept)


def _pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b (numbers of two sources), value: sum of |p - q| over the kept terms that a
    group of the tiles holds, and terms: how many they are."""
    blocks = F.ceil(F.col("v") / BLOCK_TERMS).cast("int")
    tiles = F.ceil(F.col("sources") / TILE).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    # Every source comes to every block of its language, also if it holds none of its terms.
    marks = groups.where("v > 0").select("lang", "number", "total", "v", "sources", F.lit(None).cast("string").alias("term"),
                                         F.lit(0).cast("long").alias("n"), each(blocks).alias("block"))
    terms = kept.where("n > 0").join(groups, ["lang", "source"]).select(
        "lang", "number", "total", "v", "sources", "term", "n", F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"))
    rows = terms.union(marks).withColumn("own", F.expr(f"cast(number div {TILE} as int)")).withColumn("other", each(tiles))
    rows = rows.select("lang", "block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                       "number", "total", "v", "term", "n")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v, lang = int(pdf["v"].iloc[0]), pdf["lang"].iloc[0]
        number, first = np.unique(pdf["number"].to_numpy(), return_index=True)
        total = pdf["total"].to_numpy()[first]
        own = pdf[pdf["term"].notna()]
        code, distinct = pd.factorize(own["term"])
        row = np.searchsorted(number, own["number"].to_numpy())
        p = np.repeat(_shares(np.zeros(len(total), np.int64), total, v)[:, None], len(distinct), axis=1)
        p[row, code] = _shares(own["n"].to_numpy(), total[row], v)
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        left, right = (np.flatnonzero(number // TILE == t) for t in (i, j))
        out = []
        for x in left:
            to = right[right > x] if i == j else right
            out.append((np.full(len(to), number[x]), number[to], np.abs(p[to] - p[x]).sum(axis=1)))
        a, b, value = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(3))
        return pd.DataFrame({"lang": lang, "a": a, "b": b, "value": value, "terms": len(distinct)})

    parts = rows.groupBy("lang", "block", "i", "j").applyInPandas(run, "lang string, a long, b long, value long, terms long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part (pair or term), item, value, rank: every source's distance to each
    other source of its language, and the terms that it uses most above its language."""
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "terms")
    held = counts.where(F.col("term").isNotNull())
    kept_terms = held.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(
        F.col("docs") >= min_docs).drop("docs")
    kept = stored(held.drop("docs").join(kept_terms, ["lang", "term"]), "kept")
    langs = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(
        F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # One row a group; its number within the language orders the tiles.
    by_lang = Window.partitionBy("lang")
    groups = stored(counts.where(F.col("term").isNull()).select("lang", "source").join(totals, ["lang", "source"], "left")
                    .join(langs, "lang", "left").fillna(0, ["total", "v", "lang_total"]).select(
        "lang", "source", "total", "v", "lang_total", (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long").alias("number"),
        F.count("*").over(by_lang).alias("sources")), "groups")

    p, q = share(F.col("n"), F.col("total"), F.col("v")), share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = kept.where("n > 0").join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (p - q).alias("value"))
    terms = terms.where("value > 0").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms)

    zero = share(F.lit(0).cast("long"), F.col("total"), F.col("v"))
    side = lambda s: groups.select("lang", F.col("source").alias(s), F.col("number").alias(f"{s}_number"), "v",
                                   F.when(F.col("v") > 0, zero).alias(f"{s}_zero"))
    both = side("source").join(side("item").drop("v"), "lang").where(F.col("source_number") != F.col("item_number"))
    both = both.withColumns({"a": F.least("source_number", "item_number"), "b": F.greatest("source_number", "item_number")})
    both = both.join(_pair_sums(kept, groups), ["lang", "a", "b"], "left")
    lacking = (F.col("v") - F.col("terms")) * F.abs(F.col("source_zero") - F.col("item_zero"))
    pairs = both.select("lang", "source", "item", F.coalesce(F.col("value") + lacking, F.lit(0)).cast("long").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    out = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return out(pairs, "pair").union(out(terms, "term"))


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT i, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY ALL HAVING count(DISTINCT i) >= {MIN_DOCS}),
l AS (SELECT g.lang, count(k.term) AS v, coalesce(sum(lang_n), 0) AS lang_total FROM (SELECT DISTINCT lang FROM d) g LEFT JOIN k USING (lang) GROUP BY ALL),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (CAST({SCALE} AS HUGEINT) * (coalesce(c.n, 0) + {PRIOR})) // (total + {PRIOR} * v) AS p,
             1 + (CAST({SCALE} AS HUGEINT) * (k.lang_n + {PRIOR})) // (lang_total + {PRIOR} * v) AS q
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b
      ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM x)
WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
