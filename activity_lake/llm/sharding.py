"""Sharding by proportional stratified interleaving, DataFrame functions only.

Rows of each source (stratum) are put in a seeded random order; the row of rank r
among n has the fraction (2r - 1) / 2n. All rows sorted by that fraction interleave
the sources in proportion, so cutting the order into equal runs gives every shard the
corpus mixture, with row counts at most one apart.

No window spans a stratum or the table: ranks are counted within buckets of the
shuffle key (a source that holds a third of all rows has as many buckets as any other)
and made global with running totals of the buckets' counts; the final order is cut into
bins of the fraction in the same way.

Defined cases: a null source is a stratum of its own; null ids and texts are ordinary
values; rows equal in id, stratum and text are interchangeable; an empty table gives an
empty result; with fewer rows than shards some shards are empty. Input columns are kept;
one that is named like an output (shard, slot) or starts with `_il_` is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of a stratum's shuffle order and bins of the fraction, 16**3: a window then
#: holds a few ten-thousandths of a stratum or of the table.
HEX = 3
BINS = 16 ** HEX


def interleave(docs: DataFrame, n_shards: int, id_col: str = "doc_id", stratum_col: str = "source",
               tie_col: str | None = "text_crc32", seed: str = "s1") -> DataFrame:
    """docs with shard (0 .. n_shards - 1) and slot (0 .. gapless within the shard)."""
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    extra = [F.coalesce(F.col(tie_col).cast("string"), F.lit("-"))] if tie_col else []
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("-")), *extra))
    rows = docs.drop("shard", "slot").withColumn("_il_stratum", F.coalesce(F.concat(F.lit("="), F.col(stratum_col).cast("string")), F.lit("-")))
    rows = rows.withColumn("_il_key", key).withColumn("_il_bucket", F.substring("_il_key", 1, HEX))

    # Pass 1: rank within (stratum, bucket), made global by the totals of earlier buckets.
    counts = rows.groupBy("_il_stratum", "_il_bucket").agg(F.count("*").alias("_il_n"))
    whole = Window.partitionBy("_il_stratum")
    before = whole.orderBy("_il_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select("_il_stratum", "_il_bucket", (F.sum("_il_n").over(before) - F.col("_il_n")).alias("_il_before"),
                            F.sum("_il_n").over(whole).alias("_il_total"))
    inside = Window.partitionBy("_il_stratum", "_il_bucket").orderBy("_il_key")
    ranked = rows.withColumn("_il_r", F.row_number().over(inside)).join(offsets, ["_il_stratum", "_il_bucket"])
    twice = 2 * (F.col("_il_before") + F.col("_il_r")) - 1
    ranked = ranked.withColumn("_il_twice", twice).withColumn(
        "_il_bin", F.expr(f"(_il_twice * {BINS}) div (2 * _il_total)"))

    # Pass 2: position within the bin of the fraction, made global by earlier bins.
    # At most BINS rows meet in the running total.
    bins = ranked.groupBy("_il_bin").agg(F.count("*").alias("_il_m"))
    run = Window.orderBy("_il_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.select("_il_bin", (F.sum("_il_m").over(run) - F.col("_il_m")).alias("_il_first"),
                       F.sum("_il_m").over(Window.partitionBy()).alias("_il_all"))
    order = Window.partitionBy("_il_bin").orderBy(F.col("_il_twice") / F.col("_il_total"), "_il_key", "_il_stratum")
    placed = ranked.withColumn("_il_q", F.row_number().over(order)).join(bins, "_il_bin")
    placed = placed.withColumn("_il_pos", F.col("_il_first") + F.col("_il_q") - 1)
    placed = placed.withColumn("shard", F.expr(f"cast((_il_pos * {n_shards}) div _il_all as int)"))
    # Shard s starts at the first position p with p * n_shards >= s * rows.
    placed = placed.withColumn("slot", F.expr(f"_il_pos - (shard * _il_all + {n_shards - 1}) div {n_shards}"))
    return placed.drop(*[c for c in placed.columns if c.startswith("_il_")])


def write_shards(sharded: DataFrame, path: str) -> None:
    """The shards as folders shard=k, each in slot order within its files."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def _crc32_sql(blob: str) -> str:
    """CRC-32 of a blob, a byte at a time with the table of its 16 low nibbles."""
    table = []
    for n in range(16):
        for _ in range(4):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    entry = f"{table}::BIGINT[]"
    step = f"xor(({entry})[1 + (xor({{0}}, {{1}}) & 15)], {{0}} >> 4)"
    one = step.format("c", "b")
    return (f"xor(list_reduce(list_transform(regexp_extract_all(hex({blob}), '..'), lambda x: CAST('0x' || x AS BIGINT)), "
            f"lambda c, b: {step.format('(' + one + ')', '(b >> 4)')}, 4294967295::BIGINT), 4294967295::BIGINT)")


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce('=' || source, '-') AS stratum, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size,
                  {_crc32_sql("encode(coalesce(text, ''))")} AS crc FROM documents),
k AS (SELECT *, md5(concat_ws('|', 's1', coalesce(CAST(doc_id AS VARCHAR), '-'), CAST(crc AS VARCHAR))) AS h FROM d),
r AS (SELECT *, 2 * row_number() OVER (PARTITION BY stratum ORDER BY h) - 1 AS twice, count(*) OVER (PARTITION BY stratum) AS n FROM k),
p AS (SELECT *, row_number() OVER (ORDER BY CAST(twice AS DOUBLE) / n, h, stratum) - 1 AS pos, count(*) OVER () AS total FROM r)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, CAST(pos * 24 // total AS INTEGER) AS shard,
       CAST(pos - ((pos * 24 // total) * total + 23) // 24 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM p
"""
