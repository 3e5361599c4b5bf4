"""BPE encoding and decoding with a public word-level vocabulary.

A unit's symbols form a doubly linked list; a priority queue holds (merge rank, place) of
adjacent pairs; the lowest rank merges first, leftmost first among equals; entries
whose symbols have changed since are stale and skipped when they come up. Decoding
concatenates vocabulary strings, with one space between tokens, as the tokenizer file
has no decoder. The file's path is a parameter and is opened on the workers.

Defined cases: a null text counts as empty and has no ids and an empty decoded text;
special tokens written out in a text become their ids; bytes that are not UTF-8 count as
the replacement character; repeated rows are encoded alike; an empty table gives an empty
result; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as X
from ._spark import text_bytes
from ._units import UnitEncoder


@lru_cache(maxsize=1)
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Bpe:
    """The merges and vocabulary of a tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.strings = {i: s for s, i in {**vocab, **self.special}.items()}
        self._inner = [vocab[c] for c in byte_symbols()]
        self._final = [vocab[c + suffix] for c in byte_symbols()]
        self._byte = {c: b for b, c in enumerate(byte_symbols())}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        own = Tokenizer.from_file(path)
        self._normalizer, self._cutter = own.normalizer, own.pre_tokenizer

    def merge(self, data: bytes) -> list[int]:
        """Ids of one unit's bytes."""
        n = len(data)
        if not n:
            return []
        ids = [self._inner[b] for b in data]
        ids[-1] = self._final[data[-1]]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        after[-1] = -1
        merges = self.merges
        queue = [(*m, i) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        queue_pop, queue_push = heapq.heappop, heapq.heappush
        # Entries are (rank, merged id, left place); rank and merged id go together.
        while queue:
            rank, new, i = queue_pop(queue)
            j = after[i]
            if ids[i] < 0 or j < 0 or merges.get((ids[i], ids[j])) != (rank, new):
                continue  # stale
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if m := merges.get((new, ids[k])):
                    queue_push(queue, (*m, i))
            h = before[i]
            if h >= 0 and (m := merges.get((ids[h], new))):
                queue_push(queue, (*m, h))
        return [x for x in ids if x >= 0]

    def hard(self, data: bytes) -> list[int]:
        """Ids of a word that needs the tokenizer's own normalizer and pre-tokenizer."""
        out: list[int] = []
        text = data.decode("utf-8", "replace")
        for part in self._special.split(text) if self._special else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                for piece, _ in self._cutter.pre_tokenize_str(self._normalizer.normalize_str(part)):
                    out += self.merge(bytes(self._byte[c] for c in piece))
        return out

    def units(self, spans: list[bytes], hard: bool) -> list[list[int]]:
        return [self.hard(s) if hard else self.merge(s) for s in spans]

    def encode(self, text: str) -> list[int]:
        buf = np.frombuffer(text.encode(), np.uint8)
        return UnitEncoder(self.units).block(buf, np.array([0, len(buf)]))[0].tolist()

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


@lru_cache(maxsize=1)
def encoder(path: str) -> tuple[Bpe, UnitEncoder]:
    """A worker's vocabulary and encoder, kept from task to task."""
    bpe = Bpe(path)
    return bpe, UnitEncoder(bpe.units)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  digests: bool = False) -> DataFrame:
    """id, ids (array), decoded of every row; with digests: id, n_tokens, ids_sha256 (of
    decimal ids joined by one space), decoded_sha256 in their place, made where the ids are."""
    src = docs.select(F.col(id_col).alias("id"), text_bytes(docs, text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        bpe, own_units = encoder(path)
        size = max(bpe.strings) + 1
        decimal = [str(i).encode() for i in range(size)]
        string = [bpe.strings.get(i, "").encode() for i in range(size)]
        for batch in batches:
            for at, buf, offs in X.blocks(batch.column("text")):
                ids, border = own_units.block(buf, offs)
                own = batch.column("id").slice(at, len(offs) - 1)
                if not digests:
                    lists = [ids[a:b].tolist() for a, b in zip(border[:-1], border[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [own, pa.array(lists, pa.list_(pa.int32())), pa.array([bpe.decode(x) for x in lists], pa.string())],
                        names=["id", "ids", "decoded"])
                    continue
                one, two = [], []
                for a, b in zip(border[:-1], border[1:]):
                    x = ids[a:b].tolist()
                    one.append(hashlib.sha256(b" ".join([decimal[i] for i in x])).hexdigest())
                    two.append(hashlib.sha256(b" ".join([string[i] for i in x])).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(np.diff(border)), pa.array(one), pa.array(two)],
                    names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    if digests:
        return src.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return src.mapInArrow(run, f"id {kind}, ids array<int>, decoded string")
