"""Toxicity by a convolutional text classifier, trained in NumPy.

A word's vector is the sum of hashed embeddings of the word and of its first 4 and 6
bytes. Filters of width 1, 2 and 3 slide over the whole text; each is max-pooled, and a
logistic layer on the pooled values gives the score. Labels, language, source and id
are no inputs. Thresholds are calibrated by language on all labelled rows that the net wasn't
trained on: Spark counts them by language, class and score bin, and each cut has the best F1
over these histograms, in which a language's class counts as many rows as it has labelled.

Training takes a bounded sample of labelled rows (SAMPLE_TOXIC and SAMPLE_CLEAN rows,
drawn by a hash of the id) on the driver; scoring is one map over whole texts. Both classes
of all labelled rows are counted, and the logit is shifted by the ratio of their sampling
rates: a score stands for the share among all labelled rows, whatever the sample's mix. Only
buckets that occur in MIN_DF sampled texts have a vector; others are zero, so words that
the sample doesn't hold can't move a score by a hash collision or by chance.

Defined cases: a null, empty or blank text has the score of no evidence; a null or
unknown language, and one with fewer than MIN_CALIBRATION such rows of either class, takes
the global threshold (with too few rows in all languages together: THRESHOLD); a sample without both classes gives the
score 0 for all; rows whose label is null aren't used; of several rows with one labelled id
the one with the least (language, text) is trained on; repeated rows are scored alike; an empty
table gives an empty result; `keep_clean` passes all input columns through untouched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _text as X
from ._spark import stored, text_bytes

SAMPLE_TOXIC, SAMPLE_CLEAN = 1500, 3000
#: Most bytes that a text of the training sample brings to the driver (scoring reads whole texts).
SAMPLE_TEXT_BYTES = 256 << 10
THRESHOLD = 0.3
MIN_DF = 3
DIM, FILTERS, WIDTHS = 12, 8, (1, 2, 3)
EPOCHS, BATCH, RATE, DECAY, DROP = 8, 32, 0.15, 5e-4, 0.4
#: A language's own threshold needs so many calibration rows of each class.
MIN_CALIBRATION = 15
#: Equal score bins of the histograms that thresholds are chosen from.
BINS = 1000
PAD = 3

#: Words are runs of ASCII letters and digits and of all bytes beyond ASCII.
_APART = np.ones(256, bool)
_APART[128:] = _APART[48:58] = _APART[65:91] = _APART[97:123] = False
_PREFIXES = (4, 6)


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words' 32-bit buckets, one column a feature; code of each word; border of
    each text's words). Bucket 0 stands for an absent feature."""
    w = X.words(buf, offs, apart=_APART)
    distinct, code = X.factorize(w.hashes)
    any_at = np.empty(len(distinct), np.int64)
    any_at[code] = np.arange(len(code))
    starts, ends = w.starts[any_at], w.ends[any_at]
    cols = [distinct >> np.uint64(32)]
    for n in _PREFIXES:
        h = np.full(len(starts), n, np.uint64)
        long = ends - starts >= n
        for k in range(n):
            c = X.LOWER[buf[np.minimum(starts + k, len(buf) - 1)]] if len(starts) else np.zeros(0, np.uint8)
            h = X.mix(h + c.astype(np.uint64) * X._ODD[k % 5] + np.uint64(k))
        cols.append(np.where(long, h >> np.uint64(32), np.uint64(0)))
    return np.stack(cols, axis=1), code, w.first


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Net:
    """Parameters of the classifier; row 0 of the embeddings is the zero vector."""

    buckets: np.ndarray                                   # sorted known buckets
    emb: np.ndarray
    conv: dict[int, np.ndarray] = field(default_factory=dict)   # width -> (width, DIM, FILTERS)
    bias: dict[int, np.ndarray] = field(default_factory=dict)
    out: np.ndarray = field(default_factory=lambda: np.zeros(len(WIDTHS) * FILTERS))
    out_bias: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)                # logit -> slope * logit + shift
    thresholds: dict[str, float] = field(default_factory=dict)   # "" -> the global one
    trained: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64), repr=False)  # positions in the sample

    def rows(self, buckets: np.ndarray) -> np.ndarray:
        """Embedding rows of buckets (0 for unknown ones)."""
        if not len(self.buckets):
            return np.zeros(buckets.shape, np.int64)
        at = np.minimum(np.searchsorted(self.buckets, buckets), len(self.buckets) - 1)
        return np.where((self.buckets[at] == buckets) & (buckets > 0), at + 1, 0)

    def score_block(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Scores of a block's texts."""
        buckets, code, first = features(buf, offs)
        n = len(offs) - 1
        vec = self.emb[self.rows(buckets)].sum(axis=1).astype(np.float32)
        vec = np.concatenate((vec, np.zeros((1, DIM), np.float32)))  # the last row pads
        counts = np.diff(first)
        begin = first[:-1] + PAD * np.arange(n)
        seq = np.full(len(code) + PAD * n, len(vec) - 1, np.int64)
        seq[np.arange(len(code)) + PAD * np.repeat(np.arange(n), counts)] = code
        bounds = np.stack((begin, begin + counts + 1), axis=1).reshape(-1)
        pooled = np.empty((n, len(WIDTHS) * FILTERS))
        for k, width in enumerate(WIDTHS):
            act = np.zeros((len(seq), FILTERS), np.float32)
            for i in range(width):
                act[:len(seq) - i] += (vec @ self.conv[width][i].astype(np.float32))[seq[i:]]
            top = np.maximum.reduceat(act, bounds, axis=0)[::2]
            pooled[:, k * FILTERS:(k + 1) * FILTERS] = np.maximum(top + self.bias[width], 0)
        return _sigmoid(self.scale[0] * (pooled @ self.out + self.out_bias) + self.scale[1])

    def threshold(self, lang: str | None) -> float:
        return self.thresholds.get(lang, self.thresholds.get("", THRESHOLD))


def _hold(labels: np.ndarray, langs: list[str | None], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept out of training, rows that each of them stands for). A fifth of each class
    of each language, but MIN_CALIBRATION rows where it has twice as many."""
    strata: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(langs, labels.tolist())):
        strata.setdefault(key, []).append(i)
    hold, weight = np.zeros(len(labels), bool), np.ones(len(labels))
    for at in strata.values():
        n = len(at)
        mean = max(0.2 * n, MIN_CALIBRATION if n >= 2 * MIN_CALIBRATION else 0)
        hold[rng.permutation(at)[:int(mean + rng.random())]] = True
        weight[at] = n / mean
    return hold, weight


def fit(texts: list[bytes], labels: np.ndarray, langs: list[str | None], seed: int = 7,
        weights: tuple[float, float] = (1.0, 1.0)) -> Net | None:
    """A trained net, or None if the rows don't hold both classes. A row of class y stands
    for weights[y] rows."""
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    docs = []
    for t in texts:
        buf = np.frombuffer(t, np.uint8)
        b, code, _ = features(buf, np.array([0, len(buf)]))
        docs.append(b[code] if len(code) else np.zeros((0, 1 + len(_PREFIXES)), np.uint64))
    hold, stands_for = _hold(labels, langs, rng)
    if len(set(labels[~hold].tolist())) < 2:
        hold[:] = False
    if not hold.any():
        stands_for[:] = 1
    seen = np.concatenate([np.unique(d) for d, h in zip(docs, hold) if not h])
    known, df = np.unique(seen, return_counts=True)
    known = known[(df >= MIN_DF) & (known > 0)]
    net = Net(known, np.concatenate((np.zeros((1, DIM)), rng.normal(0, 0.02, (len(known), DIM)))))
    for w in WIDTHS:
        net.conv[w] = rng.normal(0, 0.5, (w, DIM, FILTERS))
        net.bias[w] = np.zeros(FILTERS)
    net.out = rng.uniform(0.2, 0.6, len(WIDTHS) * FILTERS)
    train = np.flatnonzero(~hold)
    net.trained = train.copy()
    rows = [net.rows(d) for d in docs]
    rate = labels[train].mean()
    net.out_bias = float(np.log(rate / (1 - rate)))
    g2 = {"emb": np.full(len(net.emb), 1e-3), "out": np.full(len(net.out), 1e-3), "b": 1e-3,
          **{w: np.full(net.conv[w].shape, 1e-3) for w in WIDTHS}, **{(w,): np.full(FILTERS, 1e-3) for w in WIDTHS}}
    for _ in range(EPOCHS):
        rng.shuffle(train)
        for at in range(0, len(train), BATCH):
            # Dropped buckets make the rest of a text's evidence count as well.
            kept = rng.random(len(net.emb)) >= DROP
            _step(net, rows, labels, train[at:at + BATCH], g2, kept)
    _calibrate(net, texts, labels, np.flatnonzero(hold) if hold.any() else train, stands_for, weights)
    return net


def _step(net: Net, rows: list[np.ndarray], labels: np.ndarray, batch: np.ndarray, g2: dict, kept: np.ndarray) -> None:
    """One Adagrad step on a batch; gradients flow through each filter's best window."""
    d_emb_at, d_emb = [], []
    d_conv = {w: np.zeros_like(net.conv[w]) for w in WIDTHS}
    d_bias = {w: np.zeros(FILTERS) for w in WIDTHS}
    d_out, d_b = np.zeros_like(net.out), 0.0
    for i in batch:
        ids = np.concatenate((rows[i] * kept[rows[i]], np.zeros((PAD, rows[i].shape[1]), np.int64)))
        vec = net.emb[ids].sum(axis=1)
        n = len(rows[i]) + 1
        pooled, best = [], []
        for w in WIDTHS:
            act = sum(vec[k:k + n] @ net.conv[w][k] for k in range(w)) + net.bias[w]
            p = act.argmax(axis=0)
            best.append(p)
            pooled.append(np.maximum(act[p, np.arange(FILTERS)], 0))
        z = np.concatenate(pooled)
        err = _sigmoid(z @ net.out + net.out_bias) - labels[i]
        d_out += err * z
        d_b += err
        d_z = err * net.out * (z > 0)
        for k, w in enumerate(WIDTHS):
            g = d_z[k * FILTERS:(k + 1) * FILTERS]
            d_bias[w] += g
            for j in range(w):
                at = best[k] + j
                d_conv[w][j] += vec[at].T * g
                grad = net.conv[w][j].T * g[:, None]          # FILTERS x DIM
                for f in range(ids.shape[1]):
                    d_emb_at.append(ids[at, f])
                    d_emb.append(grad)
    m = len(batch)
    at, grad = np.concatenate(d_emb_at), np.concatenate(d_emb) / m
    rows_at, back = np.unique(at, return_inverse=True)
    total = np.zeros((len(rows_at), DIM))
    np.add.at(total, back, grad)
    total += DECAY * net.emb[rows_at]
    total[rows_at == 0] = 0
    g2["emb"][rows_at] += (total ** 2).mean(axis=1)
    net.emb[rows_at] -= RATE * total / np.sqrt(g2["emb"][rows_at])[:, None]
    for w in WIDTHS:
        for name, value, d in ((w, net.conv[w], d_conv[w]), ((w,), net.bias[w], d_bias[w])):
            d = d / m + DECAY * value
            g2[name] += d ** 2
            value -= RATE * d / np.sqrt(g2[name])
    d = d_out / m + DECAY * net.out
    g2["out"] += d ** 2
    # A filter is evidence of toxicity only: clean windows can't outweigh it.
    net.out = np.maximum(net.out - RATE * d / np.sqrt(g2["out"]), 0)
    g2["b"] += (d_b / m) ** 2
    net.out_bias -= RATE * d_b / m / np.sqrt(g2["b"])


def _best_threshold(clean: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the cut range with the best F1, from each class's rows by score bin."""
    hits, flagged = np.cumsum(toxic[::-1]), np.cumsum((clean + toxic)[::-1])
    f1 = 2 * hits / (flagged + hits[-1])          # of a cut below the k-th bin from the top
    k = int(np.argmax(f1))
    more = np.flatnonzero(flagged[k:] > flagged[k])
    low = k + int(more[0]) - 1 if len(more) else BINS - 1      # empty bins below may be cut or not
    return float((BINS - 1 - (k + low) / 2) / BINS)


def _calibrate(net: Net, texts: list[bytes], labels: np.ndarray, at: np.ndarray, stands_for: np.ndarray,
               weights: tuple[float, float]) -> None:
    """Scales the logit on rows kept out of training (logistic fit, drawn towards the
    identity) and shifts it from the sample's odds to those of all labelled rows."""
    y = labels[at]
    s = np.concatenate([net.score_block(np.frombuffer(texts[i], np.uint8), np.array([0, len(texts[i])])) for i in at])
    s = np.clip(s, 1e-12, 1 - 1e-12)
    x = np.log(s / (1 - s))
    design = np.stack((x, np.ones(len(x))), axis=1)
    own = stands_for[at] * len(at) / stands_for[at].sum()
    w, prior = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(30):
        p = _sigmoid(design @ w)
        hess = (design * (own * p * (1 - p))[:, None]).T @ design + 0.5 * np.eye(2)
        step = np.linalg.solve(hess, design.T @ (own * (p - y)) + 0.5 * (w - prior))
        w = w - np.clip(step, -1, 1)
    net.scale = (float(w[0]), float(w[1])) if w[0] > 0 else net.scale
    net.scale = (net.scale[0], net.scale[1] + float(np.log(weights[1] / weights[0])))


def _thresholds(net: Net, src: DataFrame, known: DataFrame, trained: DataFrame) -> dict[str, float]:
    """Thresholds by language and the global one (""). src (id, text, lang) is scored where it
    is read; only ids, languages and score bins meet the labels."""
    edges = np.arange(1, BINS) / BINS

    def run(batches):
        for batch in batches:
            bins = np.searchsorted(edges, _scores(net, batch.column("text")), side="right")
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("lang"), pa.array(bins.astype(np.int32))],
                                             names=["id", "lang", "bin"])

    # Rows of a repeated id count once, as its first language and bin.
    rows = src.mapInArrow(run, "id long, lang string, bin int").groupBy("id").agg(F.min(F.struct("lang", "bin")).alias("r"))
    rows = rows.join(known, "id").join(F.broadcast(trained.withColumn("trained", F.lit(1))), "id", "left")
    # Languages x classes x bins.
    counts = stored(rows.groupBy(F.col("r.lang").alias("lang"), "y", F.col("r.bin").alias("bin")).agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("trained").isNull(), 1).otherwise(0)).alias("m")), "bins")
    sums = counts.groupBy("lang", "y").agg(F.sum("n").alias("all_n"), F.sum("m").alias("all_m")).where("all_m > 0")
    weighted = counts.where("m > 0").join(sums.withColumnsRenamed({"lang": "_lang", "y": "_y"}),
                                          F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("y") == F.col("_y"))).select(
        "lang", "y", "bin", "m", (F.col("m") * F.col("all_n") / F.col("all_m")).alias("w"))
    enough = sums.where(F.col("lang").isNotNull() & (F.col("all_m") >= MIN_CALIBRATION)).groupBy("lang").agg(
        F.count("*").alias("classes")).where("classes = 2")
    # Two classes and BINS bins for each language that has enough rows.
    own = weighted.join(enough, "lang", "left_semi").select("lang", "y", "bin", "m", "w")
    total = weighted.groupBy("y", "bin").agg(F.sum("m").alias("m"), F.sum("w").alias("w")).select(
        F.lit(None).cast("string").alias("lang"), "y", "bin", "m", "w")
    found: dict[str | None, np.ndarray] = {}
    for r in own.union(total).collect():
        found.setdefault(r["lang"], np.zeros((2, 2, BINS)))[:, r["y"], r["bin"]] = r["m"], r["w"]
    return {lang or "": _best_threshold(*h[1]) for lang, h in found.items()
            if lang != "" and h[0].sum(axis=1).min() >= MIN_CALIBRATION}


def train(docs: DataFrame, labels: DataFrame, held_out: Callable[[str], Column], id_col: str = "doc_id",
          text_col: str = "text", lang_col: str | None = "lang", label_col: str = "toxic",
          sample: tuple[int, int] = (SAMPLE_TOXIC, SAMPLE_CLEAN)) -> Net | None:
    """The net of a bounded sample of the labelled rows that held_out doesn't withhold, with
    thresholds from all of them."""
    ids = docs.select(F.col(id_col).cast("long").alias("id")).where(F.col("id").isNotNull()).distinct()
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & F.col("id").isNotNull()).groupBy("id").agg(F.max("y").alias("y"))
    known = stored(known.where(~held_out("id")).join(ids, "id", "left_semi"), "labelled")
    count = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    part = lambda y, n: known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n)
    drawn = part(1, sample[0]).union(part(0, sample[1]))
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(docs, text_col).alias("text"),
                      (F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")).alias("lang"))
    # drawn has at most sum(sample) rows of two numbers.
    # Of several rows with one id the least (language, text) is taken, and a text longer than
    # SAMPLE_TEXT_BYTES gives its first and last halves of that, so that the sample is bounded.
    half = SAMPLE_TEXT_BYTES // 2
    ends = F.when(F.octet_length("text") > SAMPLE_TEXT_BYTES, F.concat(F.substring("text", 1, half), F.lit(b" "), F.substring("text", -half, half)))
    rows = src.withColumn("text", F.coalesce(ends, "text")).join(F.broadcast(drawn), "id").groupBy("id", "y").agg(
        F.min(F.struct("lang", "text")).alias("r")).select("id", "y", "r.lang", "r.text").orderBy("id").collect()
    y = np.array([r["y"] for r in rows])
    weights = tuple(count.get(k, 0) / max((y == k).sum(), 1) for k in (0, 1))
    net = fit([r["text"] or b"" for r in rows], y, [r["lang"] for r in rows], weights=weights)
    if net is not None:
        trained = docs.sparkSession.createDataFrame([(rows[i]["id"],) for i in net.trained], "id long")
        net.thresholds = _thresholds(net, src.where(F.col("id").isNotNull() & ~held_out("id")), known, trained)
        net.trained = net.trained[:0]
    return net


def _scores(net: Net | None, column: pa.Array) -> np.ndarray:
    out = [net.score_block(buf, offs) if net else np.zeros(len(offs) - 1) for _, buf, offs in X.blocks(column)]
    return np.concatenate(out) if out else np.zeros(0)


def score(docs: DataFrame, net: Net | None, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str | None = "lang") -> DataFrame:
    """id, score, lang_threshold, toxic (score >= lang_threshold) of every row."""
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    src = docs.select(F.col(id_col).alias("id"), text_bytes(docs, text_col).alias("text"), lang.alias("lang"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            s = _scores(net, batch.column("text"))
            t = np.array([net.threshold(x) if net else THRESHOLD for x in batch.column("lang").to_pylist()], float)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(s), pa.array(t), pa.array(s >= t)],
                                             names=["id", "score", "lang_threshold", "toxic"])

    return src.mapInArrow(run, f"id {kind}, score double, lang_threshold double, toxic boolean")


def keep_clean(docs: DataFrame, net: Net | None, text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """The rows of docs below their language's threshold, all columns unchanged."""
    text_at = docs.columns.index(text_col)
    lang_at = docs.columns.index(lang_col) if lang_col in docs.columns else None

    def run(batches):
        for batch in batches:
            s = _scores(net, batch.column(text_at).cast(pa.large_string()))
            langs = batch.column(lang_at).cast(pa.string()).to_pylist() if lang_at is not None else [None] * len(s)
            t = np.array([net.threshold(x) if net else THRESHOLD for x in langs], float)
            yield batch.filter(pa.array(s < t, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
