"""Language-model scoring with a log-frequency Bloom filter.

Tokens are lower-cased (A-Z) words and one end token a text. N-grams of the training
rows are counted over the whole corpus (partial counts in each task, then by segment of
the hash space). A count c has the level 1 + floor(log_b c); the filter holds the n-gram
with each level up to its own, so membership probes at levels 1, 2, 4, ... until a miss, and
then between the last hit and the miss, give the quantised count. The probability of a word is Dirichlet-smoothed:

    P(w | v) = (min(c(vw), c(v)) + MU * P(w)) / (c(v) + MU + e),  P(w) = (c(w) + 1) / (N + V + 1)

with counts from the filter, applied order by order. e = FALSE_HITS * (V + 1) is the count that
false hits are expected to add to the V + 1 successors of a context that occurs (0 for one
that doesn't), so the probabilities of a context's successors sum to about 1. A second, exact table of word counts
serves the add-one base score.

Filter and table are cut into shards by hash range of at most SHARD_BYTES; each is one
broadcast, and a worker scores a chunk of texts against one shard after the other, so its
memory holds one shard and one chunk however large the corpus is. A model beyond
max_model_bytes isn't broadcast: chunks send their distinct n-grams to groups of segments of
about GROUP_BYTES instead, a group answers all chunks at once, and the levels come back to the chunk. Nothing is pruned: every n-gram of the
corpus is in the filter.

Defined cases: a null or empty text is its end token alone; a null id counts as the empty
string for the fold; repeated rows are counted and scored each; without training rows all
scores are 0; an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _text as X
from ._spark import stored, text_bytes

ORDER = 2
LEVEL_BASE = 1.25
BITS_PER_KEY = 20
PROBES = 14
#: Share of absent keys that the filter holds by chance: all probes hit set bits.
FALSE_HITS = (1 - np.exp(-PROBES / BITS_PER_KEY)) ** PROBES
MU = 20.0
SHARD_BYTES = 64 << 20
CHUNK_BYTES = 4 << 20
#: Text whose n-grams make one segment of the hash space: a group of the counting shuffle.
SEGMENT_BYTES = 2 << 20
MAX_MODEL_BYTES = 512 << 20
#: Part of a model that isn't broadcast that answers as one: so few groups that a chunk asks each for
#: thousands of n-grams, not for dozens.
GROUP_BYTES = 16 << 20
#: Partial counts are handed on when a task holds so many n-grams.
FLUSH = 3_000_000

def digest(word: bytes) -> int:
    """64 bits of a cryptographic hash: words are known by it across the corpus, where their
    bytes can't be compared, so a pair that shares one can't be written on purpose."""
    return int.from_bytes(blake2b(word, digest_size=8).digest(), "little")


#: The end token, which no word can be spelt as.
END = np.array([digest(b"")], np.uint64)


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(digests of all tokens, border of each text's tokens); the end token closes a text."""
    w = X.words(buf, offs)
    border = w.first + np.arange(len(offs))
    code, at = w.codes()
    data = w.folded.tobytes()
    own = np.frombuffer(b"".join(blake2b(data[a:b], digest_size=8).digest() for a, b in zip(w.starts[at].tolist(), w.ends[at].tolist())), "<u8")
    return np.insert(own[code] if len(code) else own, w.first[1:], END), border


def grams(tok: np.ndarray, border: np.ndarray, order: int) -> np.ndarray:
    """Hash of the order-gram that ends at each token; contexts before a text are end tokens."""
    if order == 1:
        return tok
    parts = [tok]
    for _ in range(order - 1):
        prev = np.empty_like(tok)
        prev[1:] = parts[0][:-1]
        prev[border[:-1]] = END
        parts.insert(0, prev)
    return X.gram(parts)


def level(count: np.ndarray) -> np.ndarray:
    """Quantised count: 1 + floor(log_b count), exact at the levels' borders."""
    return np.searchsorted(_FLOORS, count, side="right")


#: Least count of each level, and the mean count that a level stands for.
_FLOORS = np.unique(np.ceil(LEVEL_BASE ** np.arange(190)).astype(np.float64))
_MEANS = np.concatenate(([0.0], (_FLOORS + np.concatenate((_FLOORS[1:] - 1, [_FLOORS[-1]]))) / 2))


def entry(key: np.ndarray, lev: np.ndarray | int) -> np.ndarray:
    """Hash of (key, level); its halves give all its probes."""
    return X.mix(key * X._ODD[0] + np.asarray(lev).astype(np.uint64) * X._ODD[1])


def place(entries: np.ndarray, bits: np.ndarray, probe: int) -> np.ndarray:
    """Bit of each entry for one probe in a segment of `bits` bits."""
    x = (entries >> np.uint64(32)) + np.uint64(probe) * (entries | np.uint64(1))
    return ((x & np.uint64(0xFFFFFFFF)) * bits.astype(np.uint64)) >> np.uint64(32)


def filter_bits(keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The filter (packed bits) of keys with their levels."""
    n = int(levels.sum())
    bits = max(64, -(-n * BITS_PER_KEY // 64) * 64)
    rep = np.repeat(keys, levels)
    lev = np.arange(n) - np.repeat(np.cumsum(levels) - levels, levels) + 1
    out = np.zeros(bits, bool)
    size, entries = np.uint64(bits), entry(rep, lev)
    for p in range(PROBES):
        out[place(entries, size, p)] = True
    return np.packbits(out, bitorder="little")


def _held(keys: np.ndarray, lev: np.ndarray, seg: np.ndarray, first: np.ndarray, bits: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Whether the filter holds each key with its level. A key leaves at its first miss."""
    entries, size, base = entry(keys, lev), bits[seg].astype(np.uint64), first[seg]
    # Places are those of `place`: its sum is taken modulo 2**32, so 32 bits of it are enough.
    x, step = (entries >> np.uint64(32)).astype(np.uint32), entries.astype(np.uint32) | np.uint32(1)
    alive, ok = np.arange(len(keys)), np.ones(len(keys), bool)
    for _ in range(PROBES):
        at = (x.astype(np.uint64) * size) >> np.uint64(32)
        ok &= (data[base + (at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        x = x + step
        if np.count_nonzero(ok) < 0.8 * len(ok):
            alive, x, step, size, base = alive[ok], x[ok], step[ok], size[ok], base[ok]
            ok = np.ones(len(alive), bool)
    out = np.zeros(len(keys), bool)
    out[alive[ok]] = True
    return out


def probe_levels(keys: np.ndarray, seg: np.ndarray, first: np.ndarray, bits: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Level of each key by membership probes: levels 1, 2, 4, ... until a miss, then bisection
    between the last hit and the miss (a key is held with every level up to its own).
    Segment s has bits[s] bits from byte first[s] of data."""
    low, high = np.zeros(len(keys), np.int64), np.full(len(keys), len(_MEANS), np.int64)
    todo = np.flatnonzero(bits[seg] > 0)
    ask = 1
    while len(todo) and ask < len(_MEANS):
        hit = _held(keys[todo], np.full(len(todo), ask), seg[todo], first, bits, data)
        high[todo[~hit]] = ask
        todo = todo[hit]
        low[todo] = ask
        ask *= 2
    todo = np.flatnonzero((low > 0) & (high - low > 1))
    while len(todo):
        mid = (low[todo] + high[todo]) // 2
        hit = _held(keys[todo], mid, seg[todo], first, bits, data)
        low[todo[hit]], high[todo[~hit]] = mid[hit], mid[~hit]
        todo = todo[high[todo] - low[todo] > 1]
    return low


def _pack(keys: np.ndarray, order: int, seg_bits: int) -> bytes:
    """Full hashes of single words; the 40 bits below the segment of longer n-grams."""
    if order == 1:
        return keys.astype("<u8").tobytes()
    return np.ascontiguousarray(short(keys, seg_bits).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpack(data: bytes, order: int) -> np.ndarray:
    if order == 1:
        return np.frombuffer(data, "<u8")
    raw = np.zeros((len(data) // 5, 8), np.uint8)
    raw[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return raw.view("<u8").reshape(-1)


def short(keys: np.ndarray, seg_bits: int) -> np.ndarray:
    return (keys << np.uint64(seg_bits)) >> np.uint64(24)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, borders of their runs) of a sorted array."""
    cut = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1], [True]))) if len(values) else np.zeros(1, np.int64)
    return values[cut[:-1]], cut


def count_ngrams(texts: DataFrame, seg_bits: int, order: int = ORDER) -> DataFrame:
    """Partial n-gram counts: n, seg, keys, counts (packed arrays) from each task."""

    def run(batches):
        held: list[list[np.ndarray]] = [[] for _ in range(order)]
        size = 0

        def flush():
            for n in range(1, order + 1):
                if not held[n - 1]:
                    continue
                every = np.concatenate(held[n - 1])
                every.sort()
                at = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
                keys, counts = every[at], np.diff(np.append(at, len(every)))
                seg = (keys >> np.uint64(64 - seg_bits)).astype(np.int64)
                some, cut = _runs(seg)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), n, np.int32)), pa.array(some.astype(np.int32)),
                     pa.array([_pack(keys[a:b], n, seg_bits) for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                     pa.array([counts[a:b].astype("<u4").tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                    names=["n", "seg", "keys", "counts"])
                held[n - 1].clear()

        for batch in batches:
            for _, buf, offs in X.blocks(batch.column("text")):
                tok, border = tokens(buf, offs)
                for n in range(1, order + 1):
                    held[n - 1].append(grams(tok, border, n))
                size += len(tok)
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()

    return texts.select("text").mapInArrow(run, "n int, seg int, keys binary, counts binary")


def _tasks(df: DataFrame) -> int:
    """Partitions for groups that cost far more than their bytes: a given number isn't coalesced by
    bytes, which would leave a few tasks most of the work."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def build_segments(partial: DataFrame) -> DataFrame:
    """n, seg, distinct, total, estimated (sum of quantised counts), bits, and for single
    words the exact keys and counts."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["n"].iloc[0])
        keys = np.concatenate([_unpack(k, n) for k in pdf["keys"]])
        counts = np.concatenate([np.frombuffer(c, "<u4") for c in pdf["counts"]]).astype(np.int64)
        keys, counts = _summed(keys, counts)
        lev = level(counts)
        return pd.DataFrame({"n": [n], "seg": [int(pdf["seg"].iloc[0])], "distinct": [len(keys)], "total": [int(counts.sum())],
                             "estimated": [float(_MEANS[lev].sum())], "bits": [filter_bits(keys, lev).tobytes()],
                             "keys": [keys.tobytes() if n == 1 else None],
                             "counts": [counts.tobytes() if n == 1 else None]})

    return partial.repartition(_tasks(partial), "n", "seg").groupBy("n", "seg").applyInPandas(
        run, "n int, seg int, distinct long, total long, estimated double, bits binary, keys binary, counts binary")


@dataclass
class Model:
    """Corpus totals and the broadcast shards, or the table of segments if it is too large."""

    order: int
    seg_bits: int
    total: int
    distinct: int
    estimated: float
    shards: list
    table: DataFrame | None = None
    group_bits: int = 0


def _payload(rows: list, lo: int, hi: int, order: int) -> dict:
    out: dict = {"lo": lo, "hi": hi}
    for n in range(1, order + 1):
        own = {r["seg"]: r for r in rows if r["n"] == n}
        size = np.array([len(own[s]["bits"]) if s in own else 0 for s in range(lo, hi)], np.int64)
        out[n] = (np.cumsum(size) - size, size * 8,
                  np.frombuffer(b"".join(own[s]["bits"] for s in range(lo, hi) if s in own), np.uint8))
        if n == 1:
            out["keys"] = np.frombuffer(b"".join(own[s]["keys"] for s in range(lo, hi) if s in own), np.uint64)
            out["counts"] = np.frombuffer(b"".join(own[s]["counts"] for s in range(lo, hi) if s in own), np.int64)
    return out


def train(texts: DataFrame, order: int = ORDER, shard_bytes: int = SHARD_BYTES,
          max_model_bytes: int = MAX_MODEL_BYTES) -> Model:
    """The model of the rows of texts (column text, bytes)."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 1
    seg_bits = int(np.clip(np.ceil(np.log2(size / SEGMENT_BYTES)), 4, 24))
    table = stored(build_segments(count_ngrams(texts, seg_bits, order)), "lm")
    sums = table.where(F.col("n") == 1).agg(F.sum("total"), F.sum("distinct"), F.sum("estimated")).first()
    weight = F.length("bits") + F.coalesce(F.length("keys"), F.lit(0)) + F.coalesce(F.length("counts"), F.lit(0))
    sizes = {r[0]: r[1] for r in table.groupBy("seg").agg(F.sum(weight)).collect()}  # one row a segment
    totals = (order, seg_bits, int(sums[0] or 0), int(sums[1] or 0), float(sums[2] or 0))
    if sum(sizes.values()) > max_model_bytes:
        return Model(*totals, [], table, int(np.clip(np.ceil(np.log2(max(sum(sizes.values()), 1) / GROUP_BYTES)), 0, seg_bits)))
    shards, lo, held = [], 0, 0
    for seg in range((1 << seg_bits) + 1):
        if seg == 1 << seg_bits or (held and held + sizes.get(seg, 0) > shard_bytes):
            part = list(table.where((F.col("seg") >= lo) & (F.col("seg") < seg)).drop("distinct", "total", "estimated").toLocalIterator())
            shards.append(spark.sparkContext.broadcast(_payload(part, lo, seg, order)))
            del part
            lo, held = seg, 0
        held += sizes.get(seg, 0)
    return Model(*totals, shards)


def _use(shard) -> dict:
    return shard.value


def _release(shard) -> None:
    """Lets go of a worker's copy; the broadcast's file stays on the executor."""
    shard.__dict__.pop("_value", None)


def _sorted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values in ascending order, place of each value among them): in hash order the
    probes walk the filter segment by segment, so that a segment stays in the cache."""
    distinct, code = X.factorize(values)
    order = np.argsort(distinct)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return distinct[order], place[code]


def _score_chunk(tok: np.ndarray, border: np.ndarray, m: Model) -> tuple[np.ndarray, ...]:
    """(n_tokens, n_known, base, score) of each text of a chunk."""
    distinct, code = _sorted(tok)
    seg_of = lambda h: (h >> np.uint64(64 - m.seg_bits)).astype(np.int64)
    exact = np.zeros(len(distinct), np.int64)
    est = {1: np.zeros(len(distinct))}
    keys = {1: distinct}
    segs, back = {1: seg_of(distinct)}, {}
    for n in range(2, m.order + 1):
        g, back[n] = _sorted(grams(tok, border, n))
        segs[n], keys[n], est[n] = seg_of(g), short(g, m.seg_bits), np.zeros(len(g))
    for shard in m.shards:
        part = _use(shard)
        for n in range(1, m.order + 1):
            at = np.flatnonzero((segs[n] >= part["lo"]) & (segs[n] < part["hi"])) if len(m.shards) > 1 else np.arange(len(segs[n]))
            est[n][at] = _MEANS[probe_levels(keys[n][at], segs[n][at] - part["lo"], *part[n])]
            if n == 1 and len(part["keys"]):
                place = np.minimum(np.searchsorted(part["keys"], keys[1][at]), len(part["keys"]) - 1)
                exact[at] = np.where(part["keys"][place] == keys[1][at], part["counts"][place], 0)
        del part
        if len(m.shards) > 1:
            _release(shard)
    est |= {n: est[n][at] for n, at in back.items()}
    return _finish(border, code, exact, est, m)


def probabilities(border: np.ndarray, code: np.ndarray, est: dict, m: Model) -> np.ndarray:
    """P of each token after its context, from the counts: est[1] of the distinct words
    (code: each token's), est[n] of the n-gram that ends at each token."""
    p = ((est[1] + 1) / (m.estimated + m.distinct + 1))[code]
    false = FALSE_HITS * (m.distinct + 1)
    context = np.empty(len(code))
    uni = est[1][code]
    end = uni[border[1:] - 1]
    for n in range(2, m.order + 1):
        seen = uni if n == 2 else np.minimum(est[n - 1], context)
        context = np.empty(len(code))
        context[1:] = seen[:-1]
        context[border[:-1]] = end  # before a text stand end tokens
        p = (np.minimum(est[n], context) + MU * p) / (context + MU + np.where(context > 0, false, 0))
    return p


def _finish(border: np.ndarray, code: np.ndarray, exact: np.ndarray, est: dict, m: Model) -> tuple[np.ndarray, ...]:
    """(n_tokens, n_known, base, score) of each text; exact are the distinct words' counts."""
    at = border[:-1]
    base = np.log10((exact + 1) / (m.total + m.distinct + 1))[code]
    return (np.diff(border), np.add.reduceat((exact > 0)[code].astype(np.int64), at),
            np.add.reduceat(base, at), np.add.reduceat(np.log10(probabilities(border, code, est, m)), at))


def _chunks(batches):
    """(texts' tokens, borders, rows) of chunks of about CHUNK_BYTES of text."""
    held, size = [], 0

    def joined():
        tok = np.concatenate([h[0] for h in held])
        shift = np.cumsum([0] + [len(h[0]) for h in held])
        border = np.concatenate([h[1][:-1] + s for h, s in zip(held, shift)] + [shift[-1:]])
        rows = pa.concat_batches([h[2] for h in held])
        held.clear()
        return tok, border, rows

    for batch in batches:
        for at, buf, offs in X.blocks(batch.column("text")):
            held.append((*tokens(buf, offs), batch.slice(at, len(offs) - 1)))
            size += len(buf)
            if size >= CHUNK_BYTES:
                yield joined()
                size = 0
    if held:
        yield joined()


_OUT = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def answer_group(n: int, asked: list, segments: list, m: Model) -> list[tuple]:
    """(levels, exact counts if n is 1) of the n-grams of each ask, from the segments of one group.
    All asks are answered in one pass, an n-gram that many ask for once."""
    keys, back = _sorted(np.concatenate([np.frombuffer(a, np.uint64) for a in asked]))
    seg = (keys >> np.uint64(64 - m.seg_bits)).astype(np.int64)
    lo, hi = int(seg[0]), int(seg[-1]) + 1
    part = _payload([r for r in segments if lo <= r["seg"] < hi], lo, hi, m.order)
    lev = probe_levels(keys if n == 1 else short(keys, m.seg_bits), seg - lo, *part[n]).astype(np.uint8)[back]
    cut = np.cumsum([0] + [len(a) // 8 for a in asked])
    if n > 1:
        return [(lev[a:b].tobytes(), None) for a, b in zip(cut[:-1], cut[1:])]
    exact = np.zeros(len(keys), np.int64)
    if len(part["keys"]):
        at = np.minimum(np.searchsorted(part["keys"], keys), len(part["keys"]) - 1)
        exact = np.where(part["keys"][at] == keys, part["counts"][at], 0)
    exact = exact[back]
    return [(lev[a:b].tobytes(), exact[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:])]


def _routed(src: DataFrame, m: Model, kind: str) -> DataFrame:
    """Scores without a broadcast. A chunk's rows and the distinct n-grams that it asks for
    are stored; a group of segments answers all chunks that ask for its n-grams; the answers
    meet the chunk's rows again. The n-grams go and their levels come back in ascending order,
    so the answers don't name them."""
    order, seg_bits, wide = m.order, m.seg_bits, m.seg_bits - m.group_bits
    totals = Model(order, seg_bits, m.total, m.distinct, m.estimated, [])

    def split(batches):
        part = TaskContext.get().partitionId()
        for number, (tok, border, rows) in enumerate(_chunks(batches)):
            chunk = f"{part}-{number}"
            n, none = len(rows), lambda k, t: pa.nulls(k, t)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk] * n), rows.column("id"), rows.column("text"), rows.column("held_out"), none(n, pa.int32()),
                 none(n, pa.int32()), none(n, pa.binary())], names=["chunk", "id", "text", "held_out", "n", "part", "keys"])
            for size in range(1, order + 1):
                keys = np.unique(grams(tok, border, size))
                some, cut = _runs((keys >> np.uint64(64 - seg_bits) >> np.uint64(wide)).astype(np.int64))
                k = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * k), none(k, rows.column("id").type), none(k, rows.column("text").type), none(k, pa.bool_()),
                     pa.array(np.full(k, size, np.int32)), pa.array(some.astype(np.int32)),
                     pa.array([keys[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                    names=["chunk", "id", "text", "held_out", "n", "part", "keys"])

    src = src.withColumn("id", F.col("id").cast("string"))  # pandas has no integers beside nulls
    parts = stored(src.mapInArrow(split, "chunk string, id string, text binary, held_out boolean, n int, part int, keys binary"), "asked")

    def answer(asked: pd.DataFrame, segments: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"chunk": asked["chunk"], "n": asked["n"], "part": asked["part"], "levels": None, "exact": None})
        if len(asked):
            got = answer_group(int(asked["n"].iloc[0]), list(asked["keys"]), segments.to_dict("records"), totals)
            out["levels"], out["exact"] = [g[0] for g in got], [g[1] for g in got]
        return out

    asked = parts.where(F.col("n").isNotNull()).select("chunk", "n", "part", "keys").repartition(_tasks(src), "n", "part")
    segments = m.table.select("n", F.expr(f"shiftright(seg, {wide})").alias("part"), "seg", "bits", "keys", "counts")
    answers = asked.groupBy("n", "part").cogroup(segments.groupBy("n", "part")).applyInPandas(
        answer, "chunk string, n int, part int, levels binary, exact binary")

    def finish(rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        data = b"".join(rows["text"])
        offs = np.concatenate(([0], np.cumsum([len(t) for t in rows["text"]])))
        tok, border = tokens(np.frombuffer(data, np.uint8), offs)
        est, exact, code = {}, None, None
        for n in range(1, order + 1):
            own = got[got["n"] == n].sort_values("part")
            means = _MEANS[np.frombuffer(b"".join(own["levels"]), np.uint8)]
            at = _sorted(grams(tok, border, n))[1]
            if n == 1:
                code, est[1], exact = at, means, np.frombuffer(b"".join(own["exact"]), np.int64)
            else:
                est[n] = means[at]
        count, known, base, score = _finish(border, code, exact, est, totals)
        return pd.DataFrame({"id": rows["id"], "held_out": rows["held_out"], "n_tokens": count, "n_known": known,
                             "train_tokens": totals.total, "base_score": base, "score": score})

    texts = parts.where(F.col("n").isNull()).select("chunk", "id", F.coalesce("text", F.lit(b"")).alias("text"), "held_out").repartition(_tasks(src), "chunk")
    out = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(finish, f"id string, {_OUT}")
    return out.withColumn("id", F.col("id").cast(kind))


def score_texts(docs: DataFrame, held_out: Callable[[str], Column], id_col: str = "doc_id", text_col: str = "text",
                order: int = ORDER, shard_bytes: int = SHARD_BYTES, max_model_bytes: int = MAX_MODEL_BYTES) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; the
    model learns from the rows whose id's held_out(column name) is false."""
    src = docs.select(F.col(id_col).alias("id"), text_bytes(docs, text_col).alias("text"), held_out(id_col).alias("held_out"))
    m = train(src.where(~F.col("held_out")).select("text"), order, shard_bytes, max_model_bytes)
    kind = src.schema["id"].dataType.simpleString()
    if m.table is not None:
        return _routed(src, m, kind)

    def run(batches):
        for tok, border, rows in _chunks(batches):
            n, known, base, score = _score_chunk(tok, border, m)
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), rows.column("held_out"), pa.array(n), pa.array(known), pa.array(np.full(len(n), m.total)),
                 pa.array(base), pa.array(score)],
                names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return src.mapInArrow(run, f"id {kind}, {_OUT}")
