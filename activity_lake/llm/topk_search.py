"""Exact top-k search by inner product over quantised vectors.

Candidates are packed into shards of TILE vectors, queries into blocks of as many; each
(query block, shard) tile is one matrix product with a partial selection of the k best,
and per-query lists are merged in a tree, FAN shards at a time. The stated query set
meets all rows in blocks; a tile is the largest thing a task holds.

Products are exact: float64 products are used where every partial sum stays below
2**53, else integers of any size (a score beyond 64 bits is held at its limit).

Defined cases: a vector that is null or holds a null or non-finite component takes no
part; vectors of different length are not compared; equal scores go to the smaller id; rows
that repeat an id are separate candidates, and none is a candidate of a query with its
own id; a null id takes no part; fewer candidates than k give shorter lists; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import stored

SCALE = 256
TILE = 2048
FAN = 64
QUERY_STEP = 50


def quantised(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, dim, v: whole-number components floor(SCALE * x), for the vectors that take part."""
    v = F.transform(F.col(vec_col), lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("double"))
    fit = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & fit).select(
        F.col(id_col).cast("long").alias("id"), F.size(vec_col).alias("dim"),
        v.alias("v"))


def _blocks(rows: DataFrame, what: str) -> DataFrame:
    """Blocks of at most about TILE rows of one dimension: ids and components as arrays."""
    counts = rows.groupBy("dim").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts"))
    # The scan's row numbers spread rows that repeat an id, or a whole row.
    dealt = rows.withColumn("own", F.monotonically_increasing_id()).join(counts, "dim").withColumn("block", F.pmod(F.xxhash64("id", "v", "own"), F.col("parts")).cast("int"))
    return stored(dealt.groupBy("dim", "block").agg(
        F.collect_list("id").alias("ids"), F.collect_list("v").alias("vs")), what)


def _product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    if q.shape[1] * float(np.abs(q).max()) * float(np.abs(c).max()) < 2.0**53:
        return (q @ c.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in m] for m in (q, c)]
    out = np.array(whole[0], dtype=object) @ np.array(whole[1], dtype=object).T
    return np.clip(out, -2**63, 2**63 - 1).astype(np.int64)


def best_of_tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> pd.DataFrame:
    """The k best candidates of each query in a tile; ties to the smaller id."""
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    scores = _product(q, c)
    out = []
    for row, own in zip(scores, q_ids):
        at = np.flatnonzero(c_ids != own)
        s = row[at]
        if len(s) > k:
            cut = np.partition(s, len(s) - k)[len(s) - k]  # the k-th best
            at, s = at[s >= cut], s[s >= cut]
        best = np.argsort(-s.astype(object) if len(s) and s.min() == -2**63 else -s, kind="stable")[:k]
        out.append((np.full(len(best), own), c_ids[at[best]], s[best]))
    return pd.DataFrame({"query_id": np.concatenate([x[0] for x in out]) if out else np.zeros(0, np.int64),
                         "vec_id": np.concatenate([x[1] for x in out]) if out else np.zeros(0, np.int64),
                         "score": np.concatenate([x[2] for x in out]) if out else np.zeros(0, np.int64)})


def top_k(vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          query_step: int = QUERY_STEP) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row whose id is divisible
    by query_step."""
    if k < 1:
        raise ValueError("k must be positive")
    rows = quantised(vectors, id_col, vec_col)
    shards = _blocks(rows, "shards").select("dim", F.col("block").alias("shard"), "ids", "vs")
    queries = _blocks(rows.where(F.pmod(F.col("id"), F.lit(query_step)) == 0), "queries").select(
        "dim", F.col("block").alias("qblock"), F.col("ids").alias("qids"), F.col("vs").alias("qvs"))
    # Each query block visits every shard of its dimension: the stated set against all
    # rows, in tiles. Blocks are copied where they are, then dealt by shard.
    sizes = shards.groupBy("dim").agg((F.max("shard") + 1).alias("n_shards"))
    visits = queries.join(sizes, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1)))
    tiles = visits.drop("n_shards").join(shards, ["dim", "shard"])

    def run(batches):
        for pdf in batches:
            for t in pdf.itertuples(index=False):
                out = best_of_tile(np.asarray(t.qids), np.stack(t.qvs), np.asarray(t.ids), np.stack(t.vs), k)
                out["shard"] = t.shard
                yield out

    lists = tiles.select("shard", "qids", "qvs", "ids", "vs").mapInPandas(
        run, "query_id long, vec_id long, score long, shard int")
    # Tree merge: each level keeps the k best of FAN lists; the last level spans all shards.
    n_shards = sizes.agg(F.max("n_shards")).first()[0] or 0
    width = 1
    while True:
        width *= FAN
        last = width >= n_shards
        keys = ["query_id"] if last else ["query_id", "node"]
        if not last:
            lists = lists.withColumn("node", F.floor(F.col("shard") / width))
        best = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        if last:
            return lists.select("query_id", "rank", "vec_id", "score")
        lists = lists.drop("rank", "node")


ORACLE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
