"""Operators 11 to 13 against brute force, on real rows and on awkward ones."""
import bisect
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from activity_lake.llm import alignment, best_fit, divergence, queries

TOK = public_tokenizers.path("word_bpe_49k.json")
A, B = (public_tokenizers.path(n) for n in queries.ALIGNED)


def frames(request):
    return [request.getfixturevalue(n) for n in ("docs001", "edge")]


# ---- 11 best-fit packing
def decreasing(lengths, window):
    """Sequences that one-at-a-time best-fit decreasing opens."""
    gaps, opened = [], 0
    for n in sorted(lengths)[::-1]:
        at = bisect.bisect_left(gaps, n)
        gap = gaps.pop(at) if at < len(gaps) else window
        opened += at >= len(gaps) + (gap != window) and gap == window
        bisect.insort(gaps, gap - n)
    return opened


def check_packing(rows, pieces, window):
    """pieces: (id, piece, start, ids, sequence, offset). Returns sequences used."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for doc, piece, start, ids, seq, off in pieces:
        assert start == piece * window and 0 < len(ids) <= window
        by_doc[doc].append((piece, ids))
        by_seq[seq].append((off, len(ids)))
    for parts in by_seq.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= window
    want, got = defaultdict(Counter), defaultdict(Counter)
    for doc, ids in rows:
        for k in range(0, len(ids), window):
            want[doc][k // window, tuple(ids[k:k + window])] += 1
    for doc, parts in by_doc.items():
        got[doc].update((p, tuple(ids)) for p, ids in parts)
    assert got == want
    return len(by_seq)


@pytest.mark.parametrize("window", [4096, 400])
def test_best_fit_packs_every_piece_once_and_tightly(request, empty, window):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(TOK)
    for df in frames(request):
        rows = [(r["doc_id"], [*own.encode(r["text"] or "", add_special_tokens=False).ids, 1]) for r in df.select("doc_id", "text").collect()]
        got = best_fit.pack_best_fit(df, TOK, window=window).collect()
        used = check_packing(rows, [(r["id"], r["piece"], r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["sequence_id"], r["offset"])
                                    for r in got], window)
        lengths = [min(window, len(ids) - k) for _, ids in rows for k in range(0, len(ids), window)]
        assert used <= 1.02 * decreasing(lengths, window) + 1
    assert best_fit.pack_best_fit(empty, TOK).count() == 0


@pytest.mark.parametrize("kind", ["one length", "third and fifth", "spread", "all full", "ones"])
def test_best_fit_assignment(spark, kind):
    rng = random.Random(5)
    lengths = {"one length": [1365] * 400, "third and fifth": [1366] * 100 + [820] * 300, "spread": [rng.randint(1, 4095) for _ in range(600)],
               "all full": [4096] * 20, "ones": [1] * 9000 + [4096, 4095, 4095]}[kind]
    df = spark.createDataFrame([(i % 3, i, n) for i, n in enumerate(lengths)], "part long, at long, length long")
    got = best_fit.assign(df).collect()
    assert sorted(r["at"] for r in got) == list(range(len(lengths))) and all(lengths[r["at"]] == r["length"] for r in got)
    used = check_packing([], [], 4096) + len({r["sequence_id"] for r in got})
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 4096
    assert used <= 1.02 * decreasing(lengths, 4096) + 1


def test_sweep_gives_each_gap_the_longest_pieces_that_fit():
    lengths = {3: (0, 5), 5: (0, 2), 9: (0, 1)}
    runs = best_fit.sweep(lengths, [(4, 0, 1), (6, 1, 1), (10, 2, 1)])
    assert [(r.length, r.pieces, r.fit, r.gap) for r in runs] == [(3, 1, 1, 0), (5, 1, 1, 1), (9, 1, 1, 2)]
    assert lengths == {3: (1, 4), 5: (1, 1), 9: (1, 0)}


# ---- 12 alignment
def brute_groups(pair, a, b):
    ends = []
    for side, ids in ((pair.a, a), (pair.b, b)):
        at, out = 0, []
        for i in ids:
            at += len(side.strings[i])
            out.append(at)
        ends.append(out)
    groups, x, y = [], 0, 0
    place = [{e: k for k, e in enumerate(own)} for own in ends]
    for cut in sorted(set(ends[0]) & set(ends[1])):
        i, j = place[0][cut] + 1, place[1][cut] + 1
        groups.append((a[x:i], b[y:j]))
        x, y = i, j
    links = []
    i = j = 0
    while i < len(a) and j < len(b):
        links.append((a[i], b[j]))
        p, q = ends[0][i], ends[1][j]
        i, j = i + (p <= q), j + (q <= p)
    return groups, links


def brute_align(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    left, right = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    left.encode_special_tokens = True
    pair, rows = alignment.Pair(A, B), []
    for t in texts:
        a, b = left.encode(" " + (t or ""), add_special_tokens=False).ids, right.encode(t or "")
        data = (" " + (t or "")).encode()
        if not t or any(b"".join(s.strings[i] for i in ids) != data for s, ids in ((pair.a, a), (pair.b, b))):
            a, b = [], []
        rows.append((a, b, *brute_groups(pair, a, b)))
    count = Counter(x for r in rows for x in r[3])
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(len(a), len(b), len(g), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
             ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g)) for a, b, g, links in rows]


AWKWARD = ["<|endoftext|> <s> </s> <unk>", "  two  blanks ", " ", "\n\n\t", "a", "▁▁ mark", "日本語テキスト🙂🙂", "é    x", "\x00\x01", "0" * 3000,
           "ab" * 4000, " " * 3000, "x̀" * 300, "'s 'LL it's", "aaaa" * 30 + "日" * 50]


def test_alignment(request, empty, spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 20_000)
    extra = spark.createDataFrame([(i, t) for i, t in enumerate(AWKWARD)], "doc_id long, text string")
    for df in [*frames(request), extra]:
        rows = df.select("doc_id", "text").collect()
        got = alignment.align(df, A, B).collect()
        want = Counter(zip([r["doc_id"] for r in rows], brute_align([r["text"] for r in rows])))
        assert Counter((r["id"], tuple(r)[1:]) for r in got) == want
    assert alignment.align(empty, A, B).count() == 0


def test_alignment_of_random_strings_and_of_both_encoders():
    rng = random.Random(3)
    alphabet = ["a", "B", "é", "日", "🙂", " ", "  ", "\n", "1", "the", "ing", "'s", "<|endoftext|>", "́", "▁", "-", " ", "\x1c"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(800)] + AWKWARD
    pair = alignment.Pair(A, B)
    slow = alignment.Pair(A, B)
    slow._ranks = None
    enc, other = pair.encode(texts), slow.encode(texts)
    assert pair._ranks is not None and all((x[0] == y[0]).all() and (x[1] == y[1]).all() for x, y in zip(enc, other))
    whole = alignment.Aligned(pair, enc)
    spelt, n_groups = alignment.spelt(whole.keys(), whole.steps(), whole.link)
    for i, (a, b) in enumerate(enc):
        groups, links = brute_groups(pair, a.tolist(), b.tolist())
        assert spelt[i].decode() == ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        own = slice(whole.link[i], whole.link[i + 1])
        assert n_groups[i] == len(groups)
        assert list(zip(whole.a_ids[whole.link_a[own]].tolist(), whole.b_ids[whole.link_b[own]].tolist())) == links


@pytest.mark.parametrize("small", [0, 12])
def test_shared_cuts(monkeypatch, small):
    monkeypatch.setattr(alignment, "SMALL", small)
    rng = np.random.default_rng(2)
    for _ in range(60):
        a = np.unique(rng.integers(0, rng.integers(2, 3000), rng.integers(1, 400)))
        b = np.unique(rng.integers(0, rng.integers(2, 3000), rng.integers(1, 400)))
        cuts = alignment.shared_cuts(a, b, np.array([0]), np.array([len(a)]))
        assert cuts.tolist() == np.flatnonzero(np.isin(a, b)).tolist()


def test_alignment_digest_columns(spark):
    out = queries.op12_align_cuts(spark, "/root/testdata/sf0.001").limit(20).collect()
    assert all(re.fullmatch("[0-9a-f]{64}", r["groups_sha256"]) or (r["groups_sha256"] == "" and r["n_a"] == 0) for r in out)
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null").first()
    own = alignment.align(spark.createDataFrame([(1, text["text"])], "doc_id long, text string"), A, B).first()
    every = {r["doc_id"]: r["groups_sha256"] for r in queries.op12_align_cuts(spark, "/root/testdata/sf0.001").collect()}
    assert every[text["doc_id"]] == hashlib.sha256(own["groups"].encode()).hexdigest()


# ---- 13 divergence
def brute_audit(rows, min_docs, top):
    """rows: (text, lang, source)."""
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        own = {s: c for (g, s), c in groups.items() if g == lang}
        whole = sum(own.values(), Counter())

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}
        p, q = {s: shares(c) for s, c in own.items()}, shares(whole)
        for s, c in own.items():
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if c[t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                for k, (item, v) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]):
                    out.add((lang, s, part, item, v, k + 1))
    return out


def long_terms():
    rng = random.Random(8)
    stem = ["x" * n for n in (7, 8, 9, 15, 16, 17, 24, 40)] + ["é" * n for n in (4, 5, 8, 9)] + ["Ab", "aB", "ab1cd", "日本", "\x7fq", "q\x00r"]
    return [(" ".join(rng.choice(stem) for _ in range(rng.randint(0, 30))), rng.choice(["en", None]), f"s{rng.randint(0, 6)}") for _ in range(200)]


@pytest.mark.parametrize("min_docs,top", [(3, 50), (30, 5)])
def test_divergence(request, spark, empty, monkeypatch, min_docs, top):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 64)
    monkeypatch.setattr(divergence, "TILE", 4)
    monkeypatch.setattr(divergence, "FLUSH", 3000)
    more = spark.createDataFrame(long_terms(), "text string, lang string, source string").withColumn("term", F.lit(1)).repartition(3)
    for df in [*frames(request), more]:
        rows = [tuple(r) for r in df.select("text", "lang", "source").collect()]
        got = divergence.audit(df, min_docs, top).collect()
        assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == brute_audit(rows, min_docs, top)
    assert divergence.audit(empty).count() == 0


def test_divergence_counts_are_exact_beyond_64_bits():
    n = np.array([0, 10**11, 4 * 10**12], np.int64)
    total = np.array([10**13] * 3, np.int64)
    assert divergence._shares(n, total, 7).tolist() == [1 + 10**9 * (x + 5) // (10**13 + 35) for x in n.tolist()]


def test_radix_order_and_packing():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 5, 500).astype(np.uint64) << np.uint64(60), rng.integers(0, 2**63, 500).astype(np.uint64) % np.uint64(70000)
    assert divergence.radix_order([a, b]).tolist() == np.lexsort((b, a)).tolist()
    data = b"abcdefghijklmnop" * 3
    buf = np.frombuffer(data, np.uint8)
    starts, ends = np.array([0, 3, 16, 33]), np.array([8, 12, 32, 48])
    assert divergence.unpacked(divergence.packed(buf, starts, ends, 2)) == [data[s:e] for s, e in zip(starts, ends)]


def test_best_fit_crc(spark):
    out = queries.op11_bulk_best_fit(spark, "/root/testdata/sf0.001")
    whole = best_fit.pack_best_fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), TOK).collect()
    want = Counter((r["id"], r["piece"], len(r["ids"]) // 4, zlib.crc32(r["ids"])) for r in whole)
    assert Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in out.collect()) == want
