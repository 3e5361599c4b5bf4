"""op3 beyond a broadcast: a group of segments answers all chunks in one pass, and a chunk asks groups, not segments."""
import numpy as np
from pyspark.sql import functions as F

from activity_lake.llm import lm_scoring as L
from activity_lake.llm import queries

SEG_BITS = 4


def _segments(n, keys, counts):
    out = []
    for seg in range(1, 1 << SEG_BITS, 2):                                   # every other one is missing
        own = (keys >> np.uint64(64 - SEG_BITS)) == seg
        k = keys[own] if n == 1 else L.short(keys[own], SEG_BITS)
        out.append({"n": n, "seg": seg, "bits": L.filter_bits(k, L.level(counts[own])).tobytes(),
                    "keys": keys[own].tobytes() if n == 1 else None, "counts": counts[own].tobytes() if n == 1 else None})
    return out


def test_a_group_answers_all_asks_in_one_pass(monkeypatch):
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2))
    counts = rng.integers(1, 500, len(keys)).astype(np.int64)
    held = (keys >> np.uint64(64 - SEG_BITS)) % np.uint64(2) == 1
    asked = [np.sort(rng.choice(keys, rng.integers(1, 300), replace=False)) for _ in range(60)]
    m = L.Model(2, SEG_BITS, 0, 0, 0.0, [])
    calls, probe = [], L.probe_levels
    monkeypatch.setattr(L, "probe_levels", lambda *a: (calls.append(1), probe(*a))[1])
    for n in (1, 2):
        got = L.answer_group(n, [a.tobytes() for a in asked], _segments(n, keys, counts), m)
        assert len(calls) == n and len(got) == len(asked)
        for ask, (levels, exact) in zip(asked, got):
            at = np.searchsorted(keys, ask)
            found, want = np.frombuffer(levels, np.uint8), np.where(held[at], L.level(counts[at]), 0)
            assert (found >= want).all() and (found > want).mean() < 0.03          # the filter's false hits
            assert exact is None if n == 2 else (np.frombuffer(exact, np.int64) == np.where(held[at], counts[at], 0)).all()


def test_a_chunk_asks_each_group_once(edge, monkeypatch):
    for name, value in (("CHUNK_BYTES", 20_000), ("SEGMENT_BYTES", 4_000)):
        monkeypatch.setattr(L, name, value)
    key = lambda r: (str(r["id"]), r["n_tokens"], r["score"])
    want = sorted(L.score_texts(edge, queries.lm_held_out).collect(), key=key)
    kept, stored = [], L.stored
    monkeypatch.setattr(L, "stored", lambda df, what: (kept.append((what, stored(df, what))), kept[-1][1])[1])
    for size, groups in ((16 << 20, 1), (20_000, 8)):
        monkeypatch.setattr(L, "GROUP_BYTES", size)
        got = sorted(L.score_texts(edge, queries.lm_held_out, max_model_bytes=0).collect(), key=key)
        assert [(r["id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got] == [(r["id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in want]
        assert np.allclose([r["score"] for r in got], [r["score"] for r in want]) and np.allclose([r["base_score"] for r in got], [r["base_score"] for r in want])
        asked = [df for what, df in kept if what == "asked"][-1]
        segments = [df for what, df in kept if what == "lm"][-1].select("seg").distinct().count()
        chunks, rows = asked.select("chunk").distinct().count(), asked.where(F.col("n").isNotNull()).count()
        assert segments >= 16 and chunks * 2 <= rows <= chunks * 2 * min(groups * 4, segments - 1)
        if groups == 1:
            assert rows == chunks * 2
