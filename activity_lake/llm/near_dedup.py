"""MinHash near-duplicates by SetSketch registers.

Every text becomes a set of hashed word shingles and a SetSketch of it: register i
holds floor(1 - log_b x) of the smallest x among the set's exponential variates of
hash function i, truncated to 16 bits. Registers of equal sets are equal, registers
of a union are the element-wise maxima (the sketch is mergeable), and two registers
agree with about the probability of the Jaccard similarity.

1. `sketches`: one map over whole texts -> content key, set size, registers, bands.
2. Texts that are equal byte for byte become one node (a pre-aggregated group-by).
3. Nodes that share a band's registers meet in a bucket; each is paired with the
   bucket's smallest node, so a bucket of g nodes gives g - 1 pairs, not g * g / 2.
4. Pairs are screened by the joint likelihood of their registers, then confirmed on
   full shingle sets; confirmed links make components.
5. Buckets that still hold several components are compared again, across components
   only, in tiles (so that no task holds a whole bucket): first by registers, to name the
   members with a likely partner, then with the texts of these alone. A tile hands on the
   links that join components, not the pairs it compared. No cap on a bucket.

Defined cases: null, empty and blank texts have an empty set and link with nothing;
texts of fewer words than a shingle have their whole sequence as one shingle; repeated
rows are copies of each other; a null id never names a component unless all ids of the
component are null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as X
from ._spark import release, stored, text_bytes, tidy

#: SetSketch parameters: base of the spacing, rate, largest register value.
SPACING, RATE, TOP = 1.001, 20.0, 65535
BANDS, ROWS = 40, 5
#: Pairs are confirmed on full sets unless the likelihood puts them this far below the
#: threshold: four to five standard errors of the estimate from 200 registers.
MARGIN = 0.12
TILE = 1024
#: A group with so many bytes of text gives its worker's free memory back.
RELEASE_BYTES = 4 << 20
#: Parts of a key that may be hot: the other side of its join is repeated so often.
SALTS = 8
#: The filter of wanted texts: at most 2**14 segments of 2**13 bits (128 words of 64 bits, each with its
#: number: 32 MB) at any size of the corpus, and places of a text's bits in its segment.
SEGMENT_BITS, PLACE_BITS, PLACES = 14, 13, 3

_RNG = np.random.default_rng(20240607)
_MUL = (_RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1))[:, None]
_ADD = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)[:, None]


def registers(shingle_set: np.ndarray) -> np.ndarray:
    """SetSketch registers (uint16) of a non-empty set of 64-bit hashes."""
    low = np.full(len(_MUL), 2**32 - 1, dtype=np.uint32)
    h = (shingle_set >> np.uint64(32)).astype(np.uint32) ^ shingle_set.astype(np.uint32)
    for at in range(0, len(h), 2048):
        x = _MUL * h[None, at:at + 2048]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x += _ADD
        np.minimum(low, x.min(axis=1), out=low)
    u = (low.astype(np.float64) + 0.5) / 2.0**32
    x_min = -np.log1p(-u) / RATE
    return np.clip(np.floor(1 - np.log(x_min) / np.log(SPACING)), 0, TOP).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of register values (n x registers -> n x bands)."""
    r = regs.astype(np.uint64).reshape(len(regs), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * X._ODD[4], r.shape[:2]).copy()
    for k in range(ROWS):
        out = X.mix(out + r[:, :, k] * X._ODD[k])
    return out.view(np.int64)


def _slope(j, more, less, same, u, v):
    """Derivative in the similarity j of the log-likelihood of (registers larger in a,
    larger in b, equal), given the shares u and v of the set sizes."""
    c = (SPACING - 1) / SPACING
    x, y = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
    px, py = (np.maximum(-np.log1p(-t * c) / np.log(SPACING), 1e-15) for t in (x, y))
    dx, dy = (c / (1 - t * c) / np.log(SPACING) for t in (x, y))
    return -more * v * dx / px - less * u * dy / py + same * (v * dx + u * dy) / np.maximum(1 - px - py, 1e-15)


def _counts(a, b, size_a, size_b):
    more, less = (a > b).sum(axis=1).astype(float), (a < b).sum(axis=1).astype(float)
    u = size_a / (size_a + size_b)
    return more, less, a.shape[1] - more - less, u, 1 - u


def joint_estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs from their registers and set sizes:
    the log-likelihood is concave in the similarity, so its slope is bisected."""
    counts = _counts(a, b, size_a, size_b)
    u, v = counts[3:]
    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(24):
        j = (lo + hi) / 2
        up = _slope(j, *counts) > 0
        lo, hi = np.where(up, j, lo), np.where(up, hi, j)
    return (lo + hi) / 2


def likely(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, least: float) -> np.ndarray:
    """Whether the joint estimate is at least `least`: the slope there is not negative."""
    return _slope(least, *_counts(a, b, size_a, size_b)) >= 0


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """id, node (content key), n_shingles, regs, bands of every row (map only)."""
    src = docs.select(F.col(id_col).cast("long").alias("id"),
                      F.unhex(F.md5(F.coalesce(text_bytes(docs, text_col), F.lit(b"")))).alias("node"),
                      text_bytes(docs, text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for at, buf, offs in X.blocks(batch.column("text")):
                w = X.words(buf, offs)
                codes = w.codes()[0]
                n = len(offs) - 1
                size = np.zeros(n, np.int64)
                regs = np.zeros((n, BANDS * ROWS), np.uint16)
                for i in range(n):
                    own = slice(w.first[i], w.first[i + 1])
                    s = X.shingles(w.hashes[own], codes[own], width)
                    size[i] = s.size
                    if s.size:
                        regs[i] = registers(s.keys)
                keys = band_keys(regs)
                some = size > 0
                part = batch.slice(at, n)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(some * BANDS))).astype(np.int32)),
                    pa.array(keys[some].reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("node"), pa.array(size),
                     pa.array([r.tobytes() for r in regs], pa.binary()), bands],
                    names=["id", "node", "n_shingles", "regs", "bands"])

    return src.mapInArrow(tidy(run), "id long, node binary, n_shingles long, regs binary, bands array<long>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), BANDS * ROWS)


def _screen(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and registers allow the similarity; one row a pair."""
    a = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("regs").alias("ra"))
    b = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("regs").alias("rb"))
    both = pairs.distinct().join(b, "b").join(a, "a").where(
        (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keep = pa.array(likely(_matrix(batch.column("ra")), _matrix(batch.column("rb")),
                                   batch.column("na").to_numpy().astype(float), batch.column("nb").to_numpy().astype(float),
                                   percent / 100 - MARGIN))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(tidy(run), "a binary, b binary")


def _salted(rows: DataFrame, names: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """rows joined with names (one row a key) on the key: the rows of a hot key are dealt to
    SALTS parts by a hash of their columns (the same on a retry), and a name is repeated for each."""
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
    many = names.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", salt).join(many, [key, "_salt"], how).drop("_salt")


def _wanted(texts: DataFrame, need: DataFrame) -> DataFrame:
    """texts without most of those whose node isn't in need, dropped where they are read by a
    Bloom filter of fixed size: it lets more texts through the fuller it is, but none is lost."""
    def places(node) -> list:
        h = F.xxhash64(node)
        return [F.shiftrightunsigned(h, PLACE_BITS * k).bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) for k in range(PLACES)]

    segment = F.shiftrightunsigned(F.xxhash64("node"), 64 - SEGMENT_BITS)
    one = F.explode(F.array(*places("node")))
    bits = need.select(segment.alias("_seg"), one.alias("at")).groupBy("_seg", F.shiftright("at", 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.expr("cast(at & 63 as int)"))).alias("b"))
    # Words without a bit are left out, so few nodes make a small filter.
    words = bits.groupBy("_seg").agg(F.map_from_entries(F.collect_list(F.struct(F.col("w").cast("int").alias("w"), "b"))).alias("_bits"))
    found = texts.withColumn("_seg", segment).join(F.broadcast(words), "_seg")
    for at in places("node"):
        word = F.coalesce(F.try_element_at("_bits", F.shiftright(at, 6).cast("int")), F.lit(0).cast("long"))
        found = found.where(F.call_function("shiftright", word, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return found.drop("_seg", "_bits")


def _texts(docs: DataFrame, text_col: str, need: DataFrame) -> DataFrame:
    """node, text of the nodes in `need`, one row each. Copies of a text are cut to one a task
    before they are shuffled."""
    texts = docs.select(F.unhex(F.md5(F.coalesce(text_bytes(docs, text_col), F.lit(b"")))).alias("node"),
                        text_bytes(docs, text_col).alias("text"))
    need = stored(need.select("node").distinct(), "need")
    return _wanted(texts, need).dropDuplicates(["node"]).join(need, "node", "left_semi")


class TextSet:
    """A text's shingles together with its words."""

    def __init__(self, text: bytes, width: int):
        buf = np.frombuffer(text, np.uint8)
        self.words = X.words(buf, np.array([0, len(buf)]))
        self.set = X.shingles(self.words.hashes, self.words.codes()[0], width)

    def windows(self) -> set[tuple[bytes, ...]]:
        """The shingles as sequences of words."""
        w, n = self.words, self.set.width
        spelt = [w.folded[a:b].tobytes() for a, b in zip(w.starts, w.ends)]
        return {tuple(spelt[i:i + n]) for i in range(len(spelt) - n + 1)} if n else set()


def _linked(a: TextSet, b: TextSet, percent: int) -> bool:
    """Whether 100 * |intersection| >= percent * |union|, on full sets of words: equal hashes
    propose common shingles, whose words are then compared."""
    x, y = a.set, b.set
    _, i, j = np.intersect1d(x.keys, y.keys, assume_unique=True, return_indices=True)
    enough = lambda common: 100 * common >= percent * (x.size + y.size - common)
    if x.size == len(x.keys) and y.size == len(y.keys):
        if not enough(len(i)):
            return False        # different shingles of one hash can only raise the count
        if not len(i):
            return enough(0)
        if x.width == y.width:
            # Words that stand in common shingles, each pair of places once.
            many = len(b.words.starts)
            pairs = np.unique((x.at[i] * many + y.at[j])[:, None] + np.arange(x.width) * (many + 1))
            p, q = np.divmod(pairs, many)
            v, w = a.words, b.words
            if X.same_spans(v.folded, v.starts[p], v.ends[p], w.folded, w.starts[q], w.ends[q]).all():
                return True
    return enough(len(a.windows() & b.windows()))


def _confirm(pairs: DataFrame, docs: DataFrame, text_col: str, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    texts = _texts(docs, text_col, pairs.select(F.explode(F.array("a", "b")).alias("node")))
    both = (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a"))

    def run(batches):
        last, last_set = None, None
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column("ta"), batch.column("tb")):     # one pair's texts at a time
                ta, tb = ta.as_py(), tb.as_py()
                if ta != last:
                    last, last_set = ta, TextSet(ta, width)
                keep.append(_linked(last_set, TextSet(tb, width), percent))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return both.select("a", "b", "ta", "tb").mapInArrow(tidy(run), "a binary, b binary")


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected component, for nodes with an
    edge. Alternates large-star and small-star steps (Kiveris et al. 2014) until the
    edges are stars; every step is a written table, so no lineage grows."""
    edges = stored(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "cc")
    before = _state(edges)
    while before[0]:
        # Large star: neighbours larger than v link to the smallest neighbour of v (v included).
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("m", "v").alias("m"))
        big = both.where(F.col("u") > F.col("v")).join(low, "v").where(F.col("u") != F.col("m")).select(
            F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        # Small star: neighbours smaller than v, and v itself, link to the smallest of them.
        low = big.groupBy("v").agg(F.min("u").alias("m"))
        small = big.join(low, "v").where(F.col("u") != F.col("m")).select(F.col("u").alias("v"), F.col("m").alias("u"))
        edges = stored(small.union(low.select("v", F.col("m").alias("u"))).distinct(), "cc")
        state = _state(edges)
        if state == before:
            break
        before = state
    labels = edges.select(F.col("v").alias("node"), F.col("u").alias("label"))
    return labels.union(edges.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct())


def _tiled(members: DataFrame, least: int = 2) -> DataFrame:
    """members (key, node, label and more) of buckets with several components and at least that
    many nodes, dealt to groups (key, i, j). The members outside the bucket's largest component
    ask (tile i of them), all members are asked (tile j of them), so the pairs within the
    largest component never meet and its members are copied once a tile of the others."""
    sizes = members.groupBy("key", "label").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.sum("c").alias("n"), F.max(F.struct("c", "label")).alias("top"))
    sizes = sizes.where((F.col("top.c") < F.col("n")) & (F.col("n") >= least)).select(
        "key", F.col("top.label").alias("top"), F.ceil((F.col("n") - F.col("top.c")) / TILE).cast("int").alias("rows"),
        F.ceil(F.col("n") / TILE).cast("int").alias("cols"))
    dealt = stored(members.join(sizes, "key").withColumn("rest", F.col("label") != F.col("top")), "residual")
    tile = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asks = dealt.where("rest").withColumn("asks", F.lit(True)).withColumn("i", tile("rows")).withColumn("j", every("cols"))
    asked = dealt.withColumn("asks", F.lit(False)).withColumn("i", every("rows")).withColumn("j", tile("cols"))
    return asks.unionByName(asked).drop("top", "rows", "cols")


def _spread(rows: DataFrame) -> DataFrame:
    """rows dealt by group to as many tasks as the session names for a shuffle: a tile's work grows with
    its pairs, so tasks aren't joined by their bytes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "i", "j")


def _candidates(pdf: pd.DataFrame, root: np.ndarray, percent: int):
    """(place of a member that asks, places of members of other components that may be
    alike, best first) of a group. root holds each member's component, and may change meanwhile."""
    regs = np.frombuffer(b"".join(pdf["regs"]), np.uint16).reshape(len(pdf), BANDS * ROWS)
    size, rest, band = pdf["n_shingles"].to_numpy().astype(float), pdf["rest"].to_numpy(bool), int(pdf["band"].iloc[0])
    rank = pd.factorize(pdf["node"], sort=True)[0]
    asked = np.flatnonzero(~pdf["asks"].to_numpy(bool))
    for at in np.flatnonzero(pdf["asks"].to_numpy(bool)):
        # Two members that both ask meet twice: the smaller node's question counts.
        to = asked[(root[asked] != root[at]) & (~rest[asked] | (rank[asked] > rank[at]))
                   & (100 * np.minimum(size[asked], size[at]) >= percent * np.maximum(size[asked], size[at]))]
        if not len(to):
            continue
        same = regs[to] == regs[at]
        # The first band that a pair shares is the bucket where it is tried.
        here = same.reshape(len(to), BANDS, ROWS).all(axis=2).argmax(axis=1) == band
        to, same = to[here], same[here]
        if not len(to):
            continue
        here = likely(np.broadcast_to(regs[at], (len(to), regs.shape[1])), regs[to], np.full(len(to), size[at]), size[to],
                      percent / 100 - MARGIN)
        if here.any():
            yield at, to[here][np.argsort(-same[here].sum(axis=1), kind="stable")]


def _across(members: DataFrame, nodes: DataFrame, docs: DataFrame, text_col: str, width: int, percent: int) -> DataFrame:
    """Links between different components that share a bucket.

    Members meet in tiles twice. First with their registers alone: a group names the members
    that have a likely partner in another component. Then these members meet with their texts:
    likely pairs are confirmed on full sets, best first; components that a confirmed link has
    joined need no further link, so a group gives fewer rows than it has members."""
    sketch = nodes.select("node", "n_shingles", "regs")

    def name(pdf: pd.DataFrame) -> pd.DataFrame:
        root, some = pd.factorize(pdf["label"])[0], np.zeros(len(pdf), bool)
        for at, to in _candidates(pdf, root, percent):
            some[at] = some[to] = True
        return pdf.loc[some, ["key", "band", "node", "label"]]

    columns = "key long, band int, node binary, label binary"
    # In a bucket of two nodes their only pair has been tried already.
    first = _spread(_tiled(members, 3).join(sketch, "node")).groupBy("key", "i", "j").applyInPandas(name, columns)
    likely_ones = stored(first.distinct(), "likely")
    texts = _texts(docs, text_col, likely_ones)

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        root = pd.factorize(pdf["label"])[0]      # component of each member; joined ones are renamed
        node, text = pdf["node"].to_numpy(), pdf["text"].to_numpy()
        sets: dict[bytes, TextSet] = {}

        def shingle_set(at: int) -> TextSet:
            if node[at] not in sets:
                sets[node[at]] = TextSet(text[at], width)
            return sets[node[at]]

        links = []
        for at, to in _candidates(pdf, root, percent):
            for other in to:
                if root[other] != root[at] and _linked(shingle_set(at), shingle_set(other), percent):
                    links.append((node[at], node[other]))
                    root[root == root[other]] = root[at]
        if sum(map(len, text)) > RELEASE_BYTES:
            release()
        return pd.DataFrame({"a": [x[0] for x in links], "b": [x[1] for x in links]})

    rows = _spread(_tiled(likely_ones).join(texts.join(sketch, "node"), "node"))
    return rows.groupBy("key", "i", "j").applyInPandas(link, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of docs: id, node, n_shingles, component (smallest id of the
    texts that are reachable over links of at least percent/100 Jaccard similarity), label
    (smallest node of these texts: unlike the id, it is never null or shared by others)."""
    table = stored(sketches(docs, id_col, text_col, width), "sketches")
    nodes = stored(table.where(F.col("n_shingles") > 0).groupBy("node").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs"), F.first("bands").alias("bands")), "nodes")
    keyed = nodes.select(F.posexplode("bands").alias("band", "key"), "node")
    leads = keyed.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n")).where(F.col("n") > 1).select("key", "a")
    members = stored(keyed.join(leads, "key"), "buckets")
    stars = members.where(F.col("node") != F.col("a")).select("a", F.col("node").alias("b"))
    tried = stored(_screen(stars, nodes, percent), "screened")
    links = stored(_confirm(tried, docs, text_col, width, percent), "links")
    label = stored(components(links), "labels")
    named = members.select("key", "band", "node").join(label, "node", "left").select(
        "key", "band", "node", F.coalesce("label", "node").alias("label"))
    more = stored(_across(named, nodes, docs, text_col, width, percent), "links")
    if not more.isEmpty():
        label = stored(components(links.union(more)), "labels")
    rows = _salted(table.select("id", "node", "n_shingles"), label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # Empty sets link with nothing: each such row is its own component, like a row without copies.
    names = rows.where(F.col("n_shingles") > 0).groupBy("label").agg(F.min("id").alias("least"), F.count("*").alias("n")).where(
        F.col("n") > 1).select("label", "least", F.lit(True).alias("many"))
    some = _salted(rows, names, "label", "left")
    own = F.col("many").isNull() | (F.col("n_shingles") == 0)
    return some.select("id", "node", "n_shingles", F.when(own, F.col("id")).otherwise(F.col("least")).alias("component"), "label")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
             percent: int = 80) -> DataFrame:
    """docs without near-duplicates: the row with the smallest id of each component stays
    (one of them, if rows repeat), with all its columns; texts without words all stay.
    Components are told apart by their label: texts that aren't alike all stay, also if
    their ids are null or the same."""
    found = stored(near_duplicates(docs, id_col, text_col, width, percent), "found")
    kept = found.where((F.col("n_shingles") > 0) & F.col("id").eqNullSafe(F.col("component")))
    kept = kept.groupBy("label").agg(F.first("component").alias("_own"), F.min("node").alias("_node"), F.count("*").alias("n"))
    empty = found.where(F.col("n_shingles") == 0).select(F.col("id").alias("_own"), F.col("node").alias("_node")).distinct()
    key = F.unhex(F.md5(F.coalesce(text_bytes(docs, text_col), F.lit(b""))))

    def rows_of(keys: DataFrame) -> DataFrame:
        return docs.join(keys, F.col(id_col).cast("long").eqNullSafe(F.col("_own")) & (key == F.col("_node")), "left_semi")

    firsts = kept.select("_own", "_node")
    if kept.where(F.col("n") > 1).isEmpty():
        return rows_of(firsts.union(empty))
    # Rows repeat: one of each id and text stays.
    once = rows_of(firsts).withColumns({"_id": F.col(id_col).cast("long"), "_key": key}).dropDuplicates(["_id", "_key"])
    return once.drop("_id", "_key").union(rows_of(empty))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, ws[i] || chr(1) || ws[i + 1] || chr(1) || ws[i + 2] AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)
      UNION ALL SELECT doc_id, array_to_string(ws, chr(1)) FROM w WHERE len(ws) IN (1, 2)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.seen)
SELECT w.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.seen) AS component_id, w.doc_id = min(r.seen) AS kept
FROM w JOIN r ON r.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id
"""
