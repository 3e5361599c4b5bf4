"""Cross-tokenizer alignment by divide and conquer at shared cuts.

A text is encoded by a byte-level BPE (A) and a piece model (B); both give tokens of the
same bytes, so each token has an end on one byte axis. `shared_cuts` finds the ends that
both have by divide and conquer: in an interval of tokens it looks for a common end near the
middle, bisecting B's ends for A's, then both halves are intervals of their own; an interval
without a common end inside is a leaf group. Intervals of all texts of a block are worked
on together, one level of the recursion at a time; the search widens fourfold around the
middle until it has seen the interval, so a leaf of n tokens costs n bisections. Intervals of
at most SMALL ends are the recursion's base: all their ends are bisected at once.

Every pair of overlapping tokens is a link. Its count, the corpus-wide links of its (A id, B
id), is summed by Spark: a chunk of texts sends each distinct pair once, with its number
of links, and gets the pair's count and rank back once. Between the two steps a text is its
links alone, two or four bytes and two bits each, from which its tokens and groups follow. No group
is larger than a chunk.

Defined cases: a text that is null or empty, isn't UTF-8, or whose tokens of either side don't
join to space + text has no tokens, groups or links (zeros, '' for groups); special tokens
written out in a text are plain text; repeated rows are aligned, and their links counted, each;
null and repeated ids are carried through; a text of any length is aligned whole; an empty table
gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as X
from ._spark import stored, text_bytes
from .bpe import byte_symbols

#: Text of a chunk (one text at least): what a task aligns, and a group of the last join holds.
CHUNK_BYTES = 2 << 20
#: Intervals of so few ends aren't halved any more.
SMALL = 12
#: Texts with a longer run of white space or of other bytes are left to the tokenizers library, whose
#: merging isn't quadratic in the length of a word.
LONG_RUN = 1000
#: Fixed value: the word pattern of byte-level BPE files.
WORD_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Side:
    """Token bytes of one vocabulary and their numbers."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.size = np.array([len(s) for s in strings], np.int64)


class Pair:
    """Both tokenizers, opened on a worker."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._a.no_truncation()
        self._a.no_padding()
        self._b = SentencePieceProcessor(model_file=path_b)
        byte = {c: b for b, c in enumerate(byte_symbols())}
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if all(c in byte for c in t)}
        strings = [b""] * (max([*vocab.values(), self._a.get_vocab_size() - 1]) + 1)
        for token, i in vocab.items():
            strings[i] = bytes(byte[c] for c in token)
        self.a = Side(strings)
        self._ranks = self._by_rank(spec, vocab, strings)
        piece = self._b.id_to_piece
        self.b = Side([bytes([int(piece(i)[3:5], 16)]) if self._b.is_byte(i) else piece(i).replace("▁", " ").encode()
                       for i in range(self._b.get_piece_size())])

    @staticmethod
    def _by_rank(spec: dict, vocab: dict[str, int], strings: list[bytes]):
        """The faster encoder of the same vocabulary, if the file is one whose merges rank by id
        and whose text is cut by the usual pattern alone; else None."""
        merged = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in spec["model"]["merges"]]
        cutter = spec.get("pre_tokenizer") or {}
        plain = (not spec.get("normalizer") and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True)
                 and not cutter.get("add_prefix_space") and not spec["model"].get("ignore_merges"))
        if not plain or merged != sorted(merged) or -1 in merged:
            return None
        from tiktoken import Encoding

        special = {t["content"] for t in spec.get("added_tokens", ())}
        return Encoding("a", pat_str=WORD_PATTERN, special_tokens={},
                        mergeable_ranks={strings[i]: i for t, i in vocab.items() if t not in special})

    def _left(self, texts: list[str], long: np.ndarray) -> list[list[int]]:
        if self._ranks is None:
            return [e.ids for e in self._a.encode_batch(texts, add_special_tokens=False)]
        return [self._a.encode(t, add_special_tokens=False).ids if far else self._ranks.encode_ordinary(t)
                for t, far in zip(texts, long)]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides of each text; no ids where it is empty or the bytes don't join to
        space + text."""
        whole = [" " + t for t in texts]
        data = [t.encode() for t in whole]
        none = np.zeros(0, np.int64)
        out = []
        for t, want, a, b in zip(texts, data, self._left(whole, long_runs(data)), self._b.encode(texts, num_threads=1)):
            same = t and all(b"".join(map(side.strings.__getitem__, ids)) == want for side, ids in ((self.a, a), (self.b, b)))
            out.append((np.array(a, np.int64), np.array(b, np.int64)) if same else (none, none))
        return out


def _distinct(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The distinct numbers of two ascending arrays, ascending."""
    both = np.sort(np.concatenate((a, b)), kind="stable")
    return both[np.concatenate(([True], both[1:] != both[:-1]))] if len(both) else both


def long_runs(texts: list[bytes]) -> np.ndarray:
    """Whether each text has a run of white space, or of other bytes, beyond LONG_RUN."""
    size = np.array([len(t) for t in texts], np.int64)
    stop = np.cumsum(size)
    space = X.SPACE[np.frombuffer(b"".join(texts), np.uint8)]
    border = _distinct(np.flatnonzero(space[1:] != space[:-1]) + 1, np.concatenate(([0], stop)))
    at = border[:-1][np.diff(border) > LONG_RUN]
    return np.bincount(np.searchsorted(stop, at, side="right"), minlength=len(texts)) > 0


@lru_cache(maxsize=1)
def tokenizers_of(path_a: str, path_b: str) -> Pair:
    """A worker's tokenizers, kept from task to task."""
    return Pair(path_a, path_b)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places in ends_a of the ends that ends_b has too, strictly inside the intervals
    first[i] <= place < last[i] (last[i] is the place of the interval's own end). Both
    arrays ascend over all texts of a block; texts don't share bytes."""
    def common(place: np.ndarray) -> np.ndarray:
        end = ends_a[place]
        return ends_b[np.minimum(np.searchsorted(ends_b, end), len(ends_b) - 1)] == end

    found = []
    lo, hi = np.asarray(first, np.int64), np.asarray(last, np.int64)
    while len(lo):
        small = hi - lo <= SMALL
        a, n = lo[small], np.maximum(hi[small] - lo[small], 0)
        place = np.arange(int(n.sum())) + np.repeat(a - np.cumsum(n) + n, n)
        found.append(place[common(place)])
        lo, hi = lo[~small], hi[~small]
        middle = (lo + hi) // 2
        cut = np.where(common(middle), middle, -1)
        left, reach = np.flatnonzero(cut < 0), 1     # probed: fewer than reach places from the middle
        while len(left):
            # Widen the search in the intervals without a cut; the nearest common end wins.
            at, wide = middle[left], 4 * reach
            a, b = np.maximum(lo[left], at - wide + 1), np.minimum(hi[left], at + wide)
            n = b - a
            row = np.repeat(np.arange(len(left)), n)
            place = np.arange(len(row)) + np.repeat(a - np.cumsum(n) + n, n)
            far = np.abs(place - at[row])
            far[~(far >= reach)] = len(ends_a)
            ask = np.flatnonzero(far < len(ends_a))
            far[ask[~common(place[ask])]] = len(ends_a)
            near = np.minimum.reduceat(2 * far + (place > at[row]), np.cumsum(n) - n)
            hit = near < 2 * len(ends_a)
            cut[left[hit]] = at[hit] + np.where(near[hit] % 2, 1, -1) * (near[hit] // 2)
            left = left[~hit & ((a > lo[left]) | (b < hi[left]))]
            reach = wide
        some = cut >= 0
        lo, hi, cut = lo[some], hi[some], cut[some]
        found.append(cut)
        lo, hi = np.concatenate((lo, cut + 1)), np.concatenate((cut, hi))
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


class Aligned:
    """Tokens and links of a list of texts; text i owns a[i]:a[i + 1] of all tokens of A,
    b[i]:b[i + 1] of B and links link[i]:link[i + 1]."""

    def __init__(self, pair: Pair, texts: list[tuple[np.ndarray, np.ndarray]]):
        ids = [np.concatenate([t[k] for t in texts]) if texts else np.zeros(0, np.int64) for k in (0, 1)]
        self.a_ids, self.b_ids = ids
        self.a, self.b = (_border([len(t[k]) for t in texts]) for k in (0, 1))
        ends_a, ends_b = np.cumsum(pair.a.size[ids[0]]), np.cumsum(pair.b.size[ids[1]])
        some = np.flatnonzero(np.diff(self.a) > 0)
        inner = shared_cuts(ends_a, ends_b, self.a[some], self.a[some + 1] - 1)
        # Groups end at the inner cuts and at the last tokens of texts. Between two cuts no end is
        # shared, so each stretch between neighbouring ends of either side is one link.
        cuts = np.sort(np.concatenate((inner, self.a[some + 1] - 1)))
        apart = np.ones(len(ends_a), bool)
        apart[cuts] = False
        stops = np.sort(np.concatenate((ends_a[apart], ends_b)), kind="stable")
        self.link_a, self.link_b = np.searchsorted(ends_a, stops), np.searchsorted(ends_b, stops)
        self.link = np.searchsorted(self.link_a, self.a)

    def keys(self) -> np.ndarray:
        """(A id, B id) of every link as one number."""
        return self.a_ids[self.link_a] << 32 | self.b_ids[self.link_b]

    def steps(self) -> np.ndarray:
        """Whether each link is the first of its A token (1) and of its B token (2)."""
        new = lambda x: np.diff(x, prepend=-1) > 0
        return (new(self.link_a) + 2 * new(self.link_b)).astype(np.uint8)


def _border(sizes) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def spelt(keys: np.ndarray, steps: np.ndarray, link: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """(groups of each text as `a1,a2|b1;a3|b2,b3`, their numbers) from the links of all texts; text i
    owns links link[i]:link[i + 1]."""
    a_ids, b_ids = (keys >> 32)[steps & 1 > 0], (keys & 0xFFFFFFFF)[steps & 2 > 0]
    link_a, link_b = np.cumsum(steps & 1) - 1, np.cumsum(steps >> 1) - 1
    # A group starts at a link that is the first of both its tokens.
    starts = np.flatnonzero(steps == 3)
    last = np.append(starts, len(steps))[1:] - 1
    group_a, group_b = link_a[last], link_b[last]
    n_a, n_b = len(a_ids), len(b_ids)
    # Order by group, then side; a token's group is the first that ends at or after it.
    group = np.concatenate((np.searchsorted(group_a, np.arange(n_a)), np.searchsorted(group_b, np.arange(n_b))))
    order = np.argsort(2 * group + (np.arange(n_a + n_b) >= n_a), kind="stable")
    mark = np.full(n_a + n_b, ord(","), np.uint8)
    mark[group_a], mark[n_a + group_b] = ord("|"), ord(";")
    ids = np.concatenate((a_ids, b_ids))[order]
    # Decimals right-aligned in a table row, the mark in its last cell.
    every = np.arange(int(ids.max()) + 1 if len(ids) else 1)
    width = len(str(every[-1]))
    table = np.stack([every // 10**k % 10 for k in range(width - 1, -1, -1)] + [every], axis=1).astype(np.uint8) + ord("0")
    size = (np.searchsorted(10 ** np.arange(1, width + 1), every, side="right") + 1)[ids]
    cells = table[ids]
    cells[:, -1] = mark[order]
    text = cells[np.arange(width, -1, -1) <= size[:, None]].tobytes()
    tokens = _border((steps & 1).astype(np.int64) + (steps >> 1))[link]
    stop = _border(size + 1)[tokens].tolist()
    return [text[x:max(x, y - 1)] for x, y in zip(stop[:-1], stop[1:])], np.diff(np.searchsorted(starts, link))


def _decoded(column: pa.Array) -> list[str]:
    """Texts; one that isn't UTF-8 counts as empty."""
    out = []
    for data in column.to_pylist():
        try:
            out.append((data or b"").decode())
        except UnicodeDecodeError:
            out.append("")
    return out


_DOC = "chunk string, id {kind}, wide boolean, links binary, steps binary, keys binary, counts binary"


def aligned_chunks(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of chunks. A text's row: id, links (places of its links' pairs among the chunk's distinct
    pairs, uint32 if wide, else uint16), steps (two bits a link). A chunk's own row (keys not null):
    its distinct pairs and how many links have each, int64."""
    src = docs.select(F.col(id_col).alias("id"), text_bytes(docs, text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    names = ["chunk", "id", "wide", "links", "steps", "keys", "counts"]

    def run(batches):
        pair, part, number = tokenizers_of(path_a, path_b), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, _, offs in X.blocks(batch.column("text"), CHUNK_BYTES):
                n = len(offs) - 1
                all_ = Aligned(pair, pair.encode(_decoded(batch.column("text").slice(at, n))))
                keys, place = X.factorize(all_.keys())
                count, wide = np.bincount(place, minlength=len(keys)), len(keys) > 1 << 16
                place, steps = place.astype("<u4" if wide else "<u2"), all_.steps()
                chunk = f"{part}-{number}"
                number += 1
                own = list(zip(all_.link[:-1].tolist(), all_.link[1:].tolist()))
                bits = [np.packbits(np.stack((steps[x:y] & 1, steps[x:y] >> 1), axis=1)).tobytes() for x, y in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * (n + 1)), pa.concat_arrays([batch.column("id").slice(at, n), pa.nulls(1, batch.column("id").type)]),
                     pa.array([wide] * (n + 1)), pa.array([*(place[x:y].tobytes() for x, y in own), None], pa.binary()),
                     pa.array([*bits, None], pa.binary()),
                     pa.array([None] * n + [keys.astype("<i8").tobytes()], pa.binary()),
                     pa.array([None] * n + [count.astype("<i8").tobytes()], pa.binary())], names=names)

    return src.mapInArrow(run, _DOC.format(kind=kind))


def _unrolled(chunks: DataFrame) -> DataFrame:
    """chunk, place, key, n of the distinct pairs of each chunk."""

    def run(batches):
        for batch in batches:
            for chunk, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "keys", "counts"))):
                keys, counts = np.frombuffer(keys, "<i8"), np.frombuffer(counts, "<i8")
                for lo in range(0, len(keys), 100_000):
                    k = keys[lo:lo + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(k)), pa.array(np.arange(lo, lo + len(k), dtype=np.int32)),
                                                      pa.array(k), pa.array(counts[lo:lo + 100_000])], names=["chunk", "place", "key", "n"])

    return chunks.where(F.col("keys").isNotNull()).select("chunk", "keys", "counts").mapInArrow(
        run, "chunk string, place int, key long, n long")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """key (A id * 2**32 + B id), links, best: the links of a pair corpus-wide, and whether no
    other pair of its B id has more. Pairs are at most the product of both vocabularies, and a B
    id's pairs at most A's."""
    sums = pairs.groupBy("key").agg(F.sum("n").alias("links"))
    b = F.col("key").bitwiseAND(F.lit(0xFFFFFFFF))
    top = sums.groupBy(b.alias("b")).agg(F.max("links").alias("most"))
    return sums.withColumn("b", b).join(top, "b").select("key", "links", (F.col("links") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (`a1,a2|b1;a3|b2,b3`) of every row."""
    chunks = stored(aligned_chunks(docs, path_a, path_b, id_col, text_col), "aligned")
    kind = chunks.schema["id"].dataType.simpleString()
    pairs = stored(_unrolled(chunks), "pairs")
    counts = stored(pair_counts(pairs), "pair-counts")
    answers = pairs.join(counts, "key").select("chunk", "place", "key", "links", "best")
    texts = chunks.where(F.col("keys").isNull()).select("chunk", F.col("id").cast("string").alias("id"), "wide", "links", "steps")

    def finish(rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        keys, links, best = (np.zeros(len(got), np.int64) for _ in range(3))
        keys[got["place"]], links[got["place"]], best[got["place"]] = got["key"], got["links"], got["best"]
        own = [np.frombuffer(x, "<u4" if w else "<u2") for x, w in zip(rows["links"], rows["wide"])]
        bits = [np.unpackbits(np.frombuffer(x, np.uint8))[:2 * len(p)].reshape(-1, 2) for x, p in zip(rows["steps"], own)]
        place, steps = np.concatenate(own), np.concatenate(bits)
        link = _border([len(p) for p in own])
        groups, n_groups = spelt(keys[place], steps[:, 0] + 2 * steps[:, 1], link)
        total = lambda x: np.diff(_border(x)[link])
        return pd.DataFrame({"id": rows["id"], "n_a": total(steps[:, 0]), "n_b": total(steps[:, 1]), "n_groups": n_groups,
                             "n_links": np.diff(link), "n_best": total(best[place]), "count_sum": total(links[place]),
                             "groups": [g.decode() for g in groups]})

    out = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        finish, "id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
    return out.withColumn("id", F.col("id").cast(kind))
