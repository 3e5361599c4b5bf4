"""Best-fit packing in bulk-synchronous rounds.

Texts become pieces of at most one window of tokens. A full piece is a sequence of its own;
all others are range-sorted by length once, so that a piece is known by its length and its
rank among the pieces of that length. Then rounds repeat until no piece is left:

1. The gaps (open sequences with their free tokens) are range-sorted and numbered. New, empty
   sequences join them where pieces are left that no gap takes, or more tokens than all gaps
   hold: in the first round as many as the tokens need.
2. A sweep over the sorted sizes, gaps ascending, gives each gap the longest pieces that fit:
   a piece's gap is the smallest one that takes it (its successor) unless pieces of higher
   rank have it already. Pieces of one length, and gaps of one size, differ by their rank
   only, so the sweep visits runs of equal sizes (two tables of at most `window` rows) and
   deals runs of ranks.
3. Each piece finds its run by a search for the successor of its rank, and its gap's number
   by division: `fit` pieces, as many as fit, go to one gap. No two tasks give a gap the same
   place, so no conflict is left.
4. Gaps shrink by what they got; one that no piece left fits is closed.

A gap that gets anything is filled by half at least, so there are about log2(window) rounds.
Every round's gaps are a written table; pieces are written once and found again by (round,
gap) in the end.

Defined cases: a null or empty text is its end id alone; repeated rows are packed each; ids of
any value and null ids are carried through; only texts longer than a window are cut; an empty
table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._spark import stored
from .packing import END_ID, tokenized

WINDOW = 4096


@dataclass(frozen=True)
class Run:
    """Pieces of one length, ranks first .. first + pieces - 1, that go to the gaps from
    number `gap` on, `fit` of them to each."""

    length: int
    first: int
    pieces: int
    fit: int
    gap: int


def sweep(lengths: dict[int, tuple[int, int]], gaps: list[tuple[int, int, int]]) -> list[Run]:
    """One sweep. lengths: length -> (first rank that isn't placed, pieces left); gaps: (size,
    number of the first gap of this size, gaps), sizes ascending. Updates lengths."""
    todo = sorted(n for n, (_, left) in lengths.items() if left)[::-1]
    fits: list[int] = []                    # lengths that fit the present gaps, longest last
    out = []
    for size, number, many in gaps:
        while todo and todo[-1] <= size:
            fits.append(todo.pop())
        while many and fits:
            n = fits[-1]
            first, left = lengths[n]
            fit = size // n
            used = min(many, -(-left // fit))
            placed = min(left, used * fit)
            out.append(Run(n, first, placed, fit, number))
            lengths[n] = (first + placed, left - placed)
            number, many = number + used, many - used
            if placed == left:
                fits.pop()
    return out


def numbered(df: DataFrame, what: str, *order: str) -> DataFrame:
    """df range-sorted by `order`, with `number` (0, 1, ... in that order): positions in the
    range partitions, made global by the totals of earlier partitions."""
    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part)), pa.array(np.arange(at, at + n))],
                                             names=[*batch.schema.names, "_part", "_at"])
            at += n

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    table = stored(ranged.mapInArrow(run, f"{kinds}, _part long, _at long"), what)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a partition.
    totals = stored(table.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "totals")
    return table.join(totals, "_part").withColumn("number", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def _placed(pieces: DataFrame, runs: list[tuple[int, Run]]) -> DataFrame:
    """pieces (length, rank, ...) with round, gap and turn (its place among the pieces that this
    round gives the gap). runs: (round, run); a bounded table of numbers, searched in each task."""
    runs = sorted(runs, key=lambda r: (r[1].length, r[1].first))
    columns = [np.array([getattr(r, f) for _, r in runs], np.int64) for f in ("length", "first", "fit", "gap")]
    rounds = np.array([t for t, _ in runs], np.int64)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)

    def run(batches):
        length, first, fit, gap = columns
        top = int(first.max()) + 1
        for batch in batches:
            n, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            # The last run of the piece's length that starts at or before its rank. Lengths and
            # ranks make one number; where that would overflow, two searches take its place.
            if top < 2**62 // (length[-1] + 1):
                at = np.searchsorted(length * top + first, n * top + np.minimum(rank, top - 1), side="right") - 1
            else:
                lo, hi = np.searchsorted(length, n), np.searchsorted(length, n, side="right")
                at = np.array([a + np.searchsorted(first[a:b], r, side="right") - 1 for a, b, r in zip(lo, hi, rank)], np.int64)
            turn, own = (rank - first[at]) % fit[at], (rank - first[at]) // fit[at]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rounds[at]), pa.array(gap[at] + own), pa.array(turn)],
                                             names=[*batch.schema.names, "round", "gap", "turn"])

    return pieces.mapInArrow(run, f"{kinds}, round long, gap long, turn long")


def assign(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """pieces (part, at, length; length at most window) with sequence_id and offset."""
    spark = pieces.sparkSession
    full = pieces.where(F.col("length") == window)
    # A full piece has a sequence of its own, numbered below zero.
    whole = numbered(full.select("part", "at", "length"), "full", "part", "at").select(
        "part", "at", "length", (-1 - F.col("number")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    ranked = numbered(pieces.where(F.col("length") < window).select("part", "at", "length"), "pieces", "length", "part", "at")
    # At most `window` rows.
    counts = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return whole
    start, lengths, before = {}, {}, 0
    for n in sorted(counts):
        start[n], before = before, before + counts[n]
        lengths[n] = (0, counts[n])
    starts = spark.createDataFrame(list(start.items()), "length long, start long")
    ranked = stored(ranked.join(F.broadcast(starts), "length").select(
        "part", "at", "length", (F.col("number") - F.col("start")).alias("rank")), "ranked")

    history: list[DataFrame] = []       # of each round: number, sequence, size (free tokens before it)
    runs: list[tuple[int, Run]] = []
    open_gaps, made = None, 0
    while any(left for _, left in lengths.values()):
        # At most `window` rows.
        table = numbered(open_gaps, "gaps", "size", "sequence") if history else None
        sizes = sorted(map(tuple, table.groupBy("size").agg(F.count("*")).collect())) if history else []
        tokens = sum(n * left for n, (_, left) in lengths.items())
        largest = max((s for s, _ in sizes), default=0)
        homeless = sum(n * left for n, (_, left) in lengths.items() if n > largest)
        new = -(-max(tokens - sum(s * n for s, n in sizes), homeless, 0) // window)
        spans, number = [], 0
        for s, n in sizes:
            spans.append((s, number, n))
            number += n
        if new:
            # Empty sequences come after all gaps, as the largest.
            fresh = spark.range(made, made + new).select(
                F.col("id").alias("sequence"), F.lit(window).cast("long").alias("size"), (F.col("id") - made + number).alias("number"))
            table, made = table.unionByName(fresh) if history else fresh, made + new
            spans.append((window, number, new))
        history.append(table)
        now = sweep(lengths, spans)
        turn = len(history) - 1
        runs += [(turn, r) for r in now]
        least = min((n for n, (_, left) in lengths.items() if left), default=None)
        if least is None:
            break
        open_gaps = _shrunk(table, now).where(F.col("size") >= least).select("sequence", "size")
    found = _placed(ranked, runs)
    rounds = [t.select(F.lit(i).cast("long").alias("round"), F.col("number").alias("gap"), "sequence", "size") for i, t in enumerate(history)]
    gaps = rounds[0]
    for t in rounds[1:]:
        gaps = gaps.union(t)
    # A gap gets pieces of one length in a round: a piece's offset follows from its turn.
    out = found.join(gaps, ["round", "gap"]).select(
        "part", "at", "length", F.col("sequence").alias("sequence_id"), (F.lit(window) - F.col("size") + F.col("turn") * F.col("length")).alias("offset"))
    return out.union(whole)


def _shrunk(gaps: DataFrame, runs: list[Run]) -> DataFrame:
    """gaps (number, sequence, size) less what the runs give them: each gap belongs to one run at most."""
    rows = sorted((r.gap, r.gap + -(-r.pieces // r.fit), r.length, r.fit, r.pieces) for r in runs) or [(0, 0, 0, 1, 0)]
    lo, hi, length, fit, pieces = (np.array(c, np.int64) for c in zip(*rows))

    def run(batches):
        for batch in batches:
            number, size = (batch.column(c).to_numpy().astype(np.int64) for c in ("number", "size"))
            at = np.maximum(np.searchsorted(lo, number, side="right") - 1, 0)
            own = (number >= lo[at]) & (number < hi[at])
            many = np.clip(pieces[at] - (number - lo[at]) * fit[at], 0, fit[at])
            yield pa.RecordBatch.from_arrays([batch.column("sequence"), pa.array(size - np.where(own, many * length[at], 0))],
                                             names=["sequence", "size"])

    return gaps.select("number", "sequence", "size").mapInArrow(run, "sequence long, size long")


def pack_best_fit(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                  end_id: int = END_ID) -> DataFrame:
    """One row a piece: id, piece (from 0), start, length, ids (binary uint32), sequence_id, offset."""
    tokens = stored(tokenized(docs, path, id_col, text_col, end_id), "tokens")
    pieces = tokens.select("part", "before", "n", F.explode(F.sequence(F.lit(0), F.expr(f"cast((n - 1) div {window} as int)"))).alias("piece"))
    pieces = pieces.select("part", (F.col("before") + F.col("piece").cast("long") * window).alias("at"),
                           F.least(F.lit(window).cast("long"), F.col("n") - F.col("piece").cast("long") * window).alias("length"))
    placed = stored(assign(pieces, window), "placed")
    cut = tokens.withColumn("piece", F.explode(F.sequence(F.lit(0), F.expr(f"cast((n - 1) div {window} as int)"))))
    start = F.col("piece").cast("long") * window
    cut = cut.select("id", "piece", "part", (F.col("before") + start).alias("at"), start.alias("start"),
                     F.expr(f"substring(ids, cast(4L * piece * {window} + 1 as int), {4 * window})").alias("ids"))
    return cut.join(placed, ["part", "at"]).select("id", "piece", "start", "length", "ids", "sequence_id", "offset")
