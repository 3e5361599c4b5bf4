"""Packing by concatenate and cut.

Pass 1 tokenizes whole texts, ends each with the end id and writes ids with the
token count before them in their partition (prefix sum within the partition). Partition
totals give each partition's global offset (prefix sum over partitions). Pass 2 cuts the
global token stream into windows of a fixed length: a text that crosses a border gives
one boundary record in each window that it touches. Only the last window is short, and
documents are not moved or shuffled.

Defined cases: a null or empty text is its end id alone; repeated rows are packed each;
ids of any value and null ids are carried through; an empty table gives an empty result; other
input columns are ignored.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text as X
from ._spark import stored, text_bytes, tidy
from ._units import UnitEncoder
from .bpe import byte_symbols

WINDOW = 2048
END_ID = 1


class LibraryUnits:
    """Ids of units by the tokenizers library: a simple unit is one piece for its BPE
    model, another one goes through the whole tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._own = Tokenizer.from_file(path)
        self._model = self._own.model
        self._symbol = str.maketrans(dict(enumerate(byte_symbols())))

    def __call__(self, spans: list[bytes], hard: bool) -> list[list[int]]:
        if hard:
            return [self._own.encode(s.decode("utf-8", "replace"), add_special_tokens=False).ids for s in spans]
        return [[t.id for t in self._model.tokenize(s.decode("latin-1").translate(self._symbol))] for s in spans]


@lru_cache(maxsize=1)
def encoder(path: str) -> UnitEncoder:
    """A worker's encoder, kept from task to task."""
    return UnitEncoder(LibraryUnits(path))


def tokenized(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID) -> DataFrame:
    """Pass 1: id, part, before (tokens before this row in its partition), n, ids (uint32
    little-endian, end id included)."""
    src = docs.select(F.col(id_col).alias("id"), text_bytes(docs, text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        own, part, total = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, buf, offs in X.blocks(batch.column("text")):
                ids, border = own.block(buf, offs)
                rows = len(offs) - 1
                ended = np.insert(ids, border[1:], end_id).astype("<u4")
                border = border + np.arange(rows + 1)
                data = ended.tobytes()
                n = np.diff(border)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, rows), pa.array(np.full(rows, part)), pa.array(total + border[:-1]),
                     pa.array(n), pa.array([data[4 * a:4 * b] for a, b in zip(border[:-1], border[1:])], pa.binary())],
                    names=["id", "part", "before", "n", "ids"])
                total += int(border[-1])

    return src.mapInArrow(tidy(run), f"id {kind}, part long, before long, n long, ids binary")


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row a piece: id, start, length, ids (binary uint32), doc_tokens, sequence_id,
    offset, begins and ends (whether the piece holds its text's first and last id)."""
    tokens = stored(tokenized(docs, path, id_col, text_col, end_id), "tokens")
    run = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = tokens.groupBy("part").agg(F.sum("n").alias("m")).select("part", (F.sum("m").over(run) - F.col("m")).alias("base"))
    # One small row a partition of pass 1, written, so that the planner knows its size.
    totals = stored(totals, "totals")
    placed = tokens.join(totals, "part").withColumn("lo", F.col("base") + F.col("before"))
    placed = placed.withColumn("hi", F.col("lo") + F.col("n"))
    pieces = placed.withColumn("sequence_id", F.explode(F.sequence(
        F.expr(f"lo div {window}"), F.expr(f"(hi - 1) div {window}"))))
    first = F.greatest("lo", F.col("sequence_id") * window)
    last = F.least("hi", (F.col("sequence_id") + 1) * window)
    pieces = pieces.withColumn("start", first - F.col("lo")).withColumn("length", last - first)
    return pieces.select(
        "id", "start", "length",
        F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))").alias("ids"),
        F.col("n").alias("doc_tokens"), "sequence_id", (first - F.col("sequence_id") * window).alias("offset"),
        (F.col("start") == 0).alias("begins"), (F.col("start") + F.col("length") == F.col("n")).alias("ends"))


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, ids (array) of every packed sequence; a group has at most one window of ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    hexed = F.transform(parts, lambda p: F.hex(p["ids"]))
    whole = pieces.groupBy("sequence_id").agg(F.concat_ws("", hexed).alias("h"))
    four = F.transform(F.sequence(F.lit(0), (F.length("h") / 8).cast("int") - 1), lambda i: F.conv(F.concat(
        *(F.substr(F.col("h"), i * 8 + F.lit(k), F.lit(2)) for k in (7, 5, 3, 1))), 16, 10).cast("int"))
    return whole.select("sequence_id", four.alias("ids"))
