"""Each operator against a brute-force version, on real rows and on awkward ones."""
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from activity_lake.llm import bpe, chat, lm_scoring, near_dedup, packing, quality, queries, sharding, topk_search, toxicity, url_filter
from activity_lake.llm import _text as X

from .conftest import edge_rows

SF = "/root/testdata/sf0.001"
TOK = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text, fold=True):
    data = (text or "").encode()
    return WORD.findall(data.lower() if fold else data)


def frames(request):
    return [request.getfixturevalue(n) for n in ("docs001", "edge")]


# ---- 1 sharding
def test_sharding_rows_law_and_mixture(request):
    for df in frames(request):
        rows = df.drop("shard").withColumn("slot", F.lit("clash"))
        out = sharding.interleave(rows, 24, tie_col="text").collect()
        n = rows.count()
        assert len(out) == n
        by = defaultdict(list)
        for r in out:
            by[r["shard"]].append(r["slot"])
        sizes = [len(by[s]) for s in range(24)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n
        assert all(sorted(v) == list(range(len(v))) for v in by.values())
        total = Counter(r["source"] for r in out)
        for s in range(24):
            own = Counter(r["source"] for r in out if r["shard"] == s)
            assert all(abs(own[k] - total[k] / 24) < 2 + 0.02 * total[k] for k in total)


def test_sharding_one_source_and_ties(spark, empty):
    rows = spark.createDataFrame([(i % 7, "same", "hot") for i in range(500)], "doc_id long, text string, source string")
    out = sharding.interleave(rows, 24, tie_col="text").groupBy("shard").count().collect()
    assert sorted(r["count"] for r in out) == [20] * 4 + [21] * 20
    assert sharding.interleave(empty, 24, tie_col="text").count() == 0
    with pytest.raises(ValueError):
        sharding.interleave(rows, 0)


def test_write_shards(docs001, tmp_path):
    sharding.write_shards(sharding.interleave(docs001, 4, tie_col="text"), f"{tmp_path}/out")
    assert docs001.sparkSession.read.parquet(f"{tmp_path}/out").groupBy("shard").count().count() == 4


# ---- 2 url filter
def brute_url(url, rules):
    host, path = "", ""
    if url is not None and "://" in url:
        m = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]
    best = None
    for verdict, rule in rules:
        rh, slash, rp = rule.partition("/")
        if (host == rh or host.endswith("." + rh)) and path.startswith(slash + rp) and host:
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return host, path, best and best[1], best[0] if best else "allow"


def test_url_filter(spark):
    urls = [None, "", "no scheme.net/", "http://net/", "http://A.NET/x?y", "https://example.net/en/p#q", "https://example.net/en",
            "http://Example.Net/en/a", "ftp://x.example.com/de/", "http://example.com", "http://org/fr/", "http://o.org/fr/z", "http://xnet/",
            "http://..net/", "http://a.net:80/", "http://é.net/ü", "://net/", "a://b://net/"] * 2
    df = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(df, queries.URL_RULES).collect()}
    assert got == {i: brute_url(u, queries.URL_RULES) for i, u in enumerate(urls)}
    assert url_filter.judge_urls(df.limit(0), queries.URL_RULES).count() == 0


def test_url_filter_long_urls(spark):
    rng = random.Random(4)
    many = ".".join(rng.choice("abcdefgh") for _ in range(500_000))
    urls = [f"http://{many}.example.net/en/x", f"http://{many}.net/" + "p/" * 400_000, "http://" + "h" * 1_000_000 + ".org/fr/",
            f"http://{'.' * 300_000}org/fr/", "http://" + "n" * 1_000_000, f"http://{many}.example.net", f"http://{many}.a.b.c/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(1)
    got = {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(df, queries.URL_RULES).collect()}
    assert got == {i: brute_url(u, queries.URL_RULES) for i, u in enumerate(urls)}
    assert {got[0][2], got[1][2], got[2][2], got[4][2]} == {"example.net/en/", "net/", "org/fr/", None}


def test_url_filter_many_rules_and_collisions(tmp_path, monkeypatch):
    rng = random.Random(3)
    rules = {f"h{rng.randint(0, 60)}.c{rng.randint(0, 9)}/" + "/".join("ab"[rng.randint(0, 1)] for _ in range(rng.randint(0, 3))): "block" for _ in range(500)}
    rules = [(rng.choice(("allow", "block")), r) for r in rules]
    parts = [(f"www.h{rng.randint(0, 70)}.c{rng.randint(0, 9)}", "/" + "/".join("ab"[rng.randint(0, 1)] for _ in range(rng.randint(0, 4)))) for _ in range(800)]
    for weak in (False, True):
        if weak:  # nearly all digests collide: only the stored strings decide
            monkeypatch.setattr(url_filter, "_digest", lambda b: len(b) % 3)
        path = tmp_path / f"rules{weak}"
        path.write_bytes(url_filter.build(rules))
        got = url_filter.DigestArray(str(path)).judge(parts)
        want = [brute_url(f"x://{h}{p}", rules)[2:] for h, p in parts]
        assert [(g if g else (None, "allow")) for g in got] == want
    with pytest.raises(ValueError):
        url_filter.build(rules, max_bytes=10)
    with pytest.raises(ValueError):
        url_filter.build([("allow", "a/"), ("block", "a/")])


# ---- 3 LM scoring
def test_lm_base_is_exact_and_model_helps(request):
    for df in frames(request):
        rows = df.select("doc_id", "text").collect()
        held = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2
        count = Counter()
        for r in rows:
            if not held(r["doc_id"]):
                count.update(words(r["text"]))
                count["END"] += 1
        total, distinct = sum(count.values()), len(count)
        got = lm_scoring.score_texts(df, queries.lm_held_out, shard_bytes=60_000).collect()
        many = lm_scoring.score_texts(df, queries.lm_held_out).collect()
        key = lambda r: (r["id"] is None, r["id"], r["n_tokens"], r["score"])
        for a, b in zip(sorted(got, key=key), sorted(many, key=key)):
            assert a[:6] == b[:6] and math.isclose(a["score"], b["score"], rel_tol=1e-9)
        want = []
        for r in rows:
            tok = [*words(r["text"]), "END"]
            want.append((r["doc_id"], held(r["doc_id"]), len(tok), sum(count[t] > 0 for t in tok), total,
                         round(sum(math.log10((count[t] + 1) / (total + distinct + 1)) for t in tok), 6)))
        assert Counter((r["id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == Counter(want)
        out = [r for r in got if r["held_out"]]
        assert all(r["score"] < 0 for r in got)
        assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_lm_beyond_the_broadcast_bound(request, monkeypatch):
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 50_000)
    for df in frames(request):
        key = lambda r: (r["id"] is None, r["id"], r["n_tokens"], r["score"])
        one = sorted(lm_scoring.score_texts(df, queries.lm_held_out).collect(), key=key)
        two = sorted(lm_scoring.score_texts(df, queries.lm_held_out, max_model_bytes=0).collect(), key=key)
        assert [r[:5] for r in one] == [r[:5] for r in two]
        for a, b in zip(one, two):
            assert math.isclose(a["score"], b["score"], rel_tol=1e-9) and math.isclose(a["base_score"], b["base_score"], rel_tol=1e-9)


def test_lm_matches_the_formula(spark):
    texts = ["a b a b a c", "b a", "", None, "d d d d d d d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["score"] for r in lm_scoring.score_texts(df, lambda c: F.lit(False)).collect()}
    uni, bi = Counter(), Counter()
    for t in texts:
        tok = [*words(t), "E"]
        uni.update(tok)
        bi.update(zip(["E", *tok[:-1]], tok))
    q = lambda c: float(lm_scoring._MEANS[lm_scoring.level(np.array([c]))[0]]) if c else 0.0
    z = sum(q(c) for c in uni.values()) + len(uni) + 1
    false = lm_scoring.FALSE_HITS * (len(uni) + 1)
    for i, t in enumerate(texts):
        tok, s = [*words(t), "E"], 0
        for v, w in zip(["E", *tok[:-1]], tok):
            s += math.log10((min(q(bi[v, w]), q(uni[v])) + lm_scoring.MU * (q(uni[w]) + 1) / z) / (q(uni[v]) + lm_scoring.MU + false))
        assert math.isclose(got[i], s, rel_tol=1e-9)


def test_lm_filter_has_no_misses_and_few_false_hits():
    keys = X.mix(np.arange(1, 20001, dtype=np.uint64))
    lev = (np.arange(20000) % 5 + 1).astype(np.int64)
    data = lm_scoring.filter_bits(keys[:10000], lev[:10000])
    args = (np.zeros(20000, np.int64), np.array([0]), np.array([len(data) * 8]), data)
    found = lm_scoring.probe_levels(keys, *args)
    assert (found[:10000] >= lev[:10000]).all()
    assert (found[:10000] > lev[:10000]).mean() < 0.002 and (found[10000:] > 0).mean() < 0.002
    absent = X.mix(np.arange(10**7, 10**7 + 3 * 10**6, dtype=np.uint64))
    hits = lm_scoring.probe_levels(absent, np.zeros(len(absent), np.int64), *args[1:]) > 0
    assert 0.3 < hits.mean() / lm_scoring.FALSE_HITS < 3


def test_lm_levels_of_any_height_are_found():
    keys = X.mix(np.arange(1, 3001, dtype=np.uint64))
    lev = np.arange(3000, dtype=np.int64) % (len(lm_scoring._MEANS) - 1) + 1     # the highest level too
    parts = [lm_scoring.filter_bits(keys[i::2], lev[i::2]) for i in range(2)]    # two segments of unequal size
    size = np.array([len(p) for p in parts])
    found = lm_scoring.probe_levels(keys, np.arange(3000) % 2, np.cumsum(size) - size, size * 8, np.concatenate(parts))
    assert (found >= lev).all() and (found != lev).mean() < 0.005
    assert not lm_scoring.probe_levels(keys[:5], np.zeros(5, np.int64), np.array([0]), np.array([0]), parts[0]).any()   # an empty segment


@pytest.mark.parametrize("seen", [1, 5, 60])
def test_lm_probabilities_of_a_context_sum_to_one(seen):
    """Contexts that occur `seen` times among 100,000 words, with production parameters."""
    rng = np.random.default_rng(seen)
    vocab = np.array([lm_scoring.digest(b"w%d" % i) for i in range(100_000)], np.uint64)
    end, contexts = len(vocab), 16
    words_ = np.append(vocab, lm_scoring.END)
    # One text: every word but the contexts once or more, then each context with its successors.
    body = rng.permutation(np.concatenate((np.arange(contexts, end), rng.integers(contexts, end, 100_000))))
    pairs = np.stack((np.repeat(np.arange(contexts), seen), rng.integers(contexts, 60, seen * contexts)), axis=1)
    text = np.concatenate((body, pairs.reshape(-1), [end]))
    tok, border = words_[text], np.array([0, len(text)])
    tables = {}
    for n in (1, 2):
        keys, counts = np.unique(lm_scoring.grams(tok, border, n), return_counts=True)
        tables[n] = (keys, lm_scoring.level(counts), lm_scoring.filter_bits(keys, lm_scoring.level(counts)))
    m = lm_scoring.Model(2, 0, len(text), len(tables[1][0]), float(lm_scoring._MEANS[tables[1][1]].sum()), [])
    means = lambda n, keys: lm_scoring._MEANS[lm_scoring.probe_levels(
        keys, np.zeros(len(keys), np.int64), np.array([0]), np.array([len(tables[n][2]) * 8]), tables[n][2])]
    uni, rows, sums = means(1, words_), np.arange(len(words_) + 1) * 2, []
    for v in range(contexts):
        # All texts "context, any word": the second token's probabilities are those of the context.
        ask = np.stack((np.full(len(words_), v), np.arange(len(words_))), axis=1).reshape(-1)
        sums.append(lm_scoring.probabilities(rows, ask, {1: uni, 2: means(2, lm_scoring.grams(words_[ask], rows, 2))}, m)[1::2].sum())
    assert 0.9 < np.mean(sums) < 1.1 and 0.6 < min(sums) and max(sums) < 1.5


def test_lm_empty_and_without_training_rows(empty, edge):
    assert lm_scoring.score_texts(empty, queries.lm_held_out).count() == 0
    rows = lm_scoring.score_texts(edge, lambda c: F.lit(True)).collect()
    assert {(r["score"], r["base_score"], r["n_known"]) for r in rows} == {(0.0, 0.0, 0)}


# ---- 4 toxicity
def test_toxicity_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = queries.op4_toxicity_cnn(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    assert out and docs.count() == 10000
    toxic, clean = [r["score"] for r in out if r["toxic"] is not None and r["quality"] is not None and _label(r) == 1], [r["score"] for r in out if _label(r) == 0]
    assert np.mean(np.array(clean) >= 0.3) < 0.03
    assert np.mean(np.array(toxic) >= 0.3) > 0.75


def _label(r):
    return r[len(r) - 1]  # labels.toxic is the last column


def test_toxicity_edges(edge, empty, spark):
    labels = spark.createDataFrame([(7, 1), (7, 1), (8, 0), (100, 0), (200, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    net = toxicity.train(edge, labels, lambda c: F.lit(False))
    out = toxicity.score(edge, net).collect()
    assert len(out) == edge.count() and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["id"] in (0, 1, 2)}) == 1
    kept = toxicity.keep_clean(edge, net)
    assert kept.schema == edge.schema and kept.count() == sum(not r["toxic"] for r in out)
    none = toxicity.train(edge, labels.where("toxic = 0"), lambda c: F.lit(False))
    assert none is None and {r["score"] for r in toxicity.score(edge, none).collect()} == {0.0}
    assert toxicity.keep_clean(empty, net).count() == 0
    assert toxicity.train(empty, labels, lambda c: F.lit(False)) is None


def test_toxicity_score_ignores_block_borders(edge):
    texts = [(r[1] or "").encode() for r in edge_rows()]
    net = toxicity.fit(texts, np.array([i % 2 for i in range(len(texts))]), ["en"] * len(texts))
    alone = [net.score_block(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    offs = np.cumsum([0] + [len(t) for t in texts])
    assert np.allclose(net.score_block(np.frombuffer(b"".join(texts), np.uint8), offs), alone, atol=1e-5)


# ---- 5 top-k
def toxic_rows(n, share, seed, langs=("en",)):
    """(doc_id, text, lang, toxic): a toxic text mostly holds one of the marks, a clean one seldom."""
    rng = random.Random(seed)
    vocab, marks = [f"w{i}" for i in range(60)], [f"mark{i}" for i in range(4)]
    rows = []
    for i in range(n):
        toxic = int(rng.random() < share)
        text = [rng.choice(vocab) for _ in range(12)]
        if rng.random() < (0.7 if toxic else 0.1):
            text[rng.randrange(12)] = rng.choice(marks)
        rows.append((i, " ".join(text), langs[i % len(langs)], toxic))
    return rows


def test_toxicity_score_means_the_share_of_the_table_when_the_caps_bite(spark):
    rows = toxic_rows(12000, 0.06, 3)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    net = toxicity.train(docs, labels, lambda c: F.lit(False), sample=(400, 600))
    truth = {r[0]: r[3] for r in rows}
    scores = [r["score"] for r in toxicity.score(docs, net).collect()]
    # The sample's mix is 40% toxic; the calibration fold holds about 200 rows.
    assert 0.6 < np.mean(scores) / np.mean(list(truth.values())) < 1.6


def test_toxicity_thresholds_come_from_all_labelled_rows(spark):
    rows = toxic_rows(9000, 0.1, 4, langs=["en"] * 40 + ["fr"] * 19 + ["de"]) + [(9000 + i, "w1 mark1", None, i % 2) for i in range(8)]
    rows += [(9100 + i, f"w{i} mark{i % 4}", "xx", 1) for i in range(20)]          # one class only
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    net = toxicity.train(docs.union(docs.limit(50)), labels, lambda c: F.lit(False), sample=(150, 300))
    assert {"", "en", "fr"} <= set(net.thresholds) and "xx" not in net.thresholds
    assert net.threshold("xx") == net.threshold(None) == net.thresholds[""]
    truth = {r[0]: r[3] for r in rows}
    out = toxicity.score(docs.where("lang = 'fr'"), net).collect()
    s, y = np.array([r["score"] for r in out]), np.array([truth[r["id"]] for r in out])
    f1 = lambda t: 2 * (y * (s >= t)).sum() / ((s >= t).sum() + y.sum())
    assert f1(net.thresholds["fr"]) > max(f1(t) for t in np.arange(100, 701) / 1000) - 0.02


def test_toxicity_cut_in_bins():
    rng = np.random.default_rng(3)
    s, y = rng.random(300), rng.random(300)
    y = (y < s ** 3).astype(int)
    bins = [np.bincount((s[y == k] * toxicity.BINS).astype(int), minlength=toxicity.BINS) for k in (0, 1)]
    f1 = lambda t: 2 * (y * (s >= t)).sum() / ((s >= t).sum() + y.sum())
    t = toxicity._best_threshold(*bins)
    assert np.isclose(f1(t), max(f1(k / toxicity.BINS) for k in range(toxicity.BINS)))


def test_toxicity_fold_is_drawn_by_language():
    labels = np.array([1] * 40 + [0] * 300 + [1] * 20)
    langs = ["fr"] * 340 + ["es"] * 20
    hold, weight = toxicity._hold(labels, langs, np.random.default_rng(1))
    assert hold[:40].sum() == 15 and hold[40:340].sum() == 60 and hold[340:].sum() == 4
    assert np.isclose(weight[0], 40 / 15) and weight[50] == 5


def brute_topk(rows, k):
    vecs = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, q in vecs:
        if qi % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(q, c)), ci) for ci, c in vecs if ci != qi and len(c) == len(q))[:k]
            out += [(qi, n + 1, ci, -x) for n, (x, ci) in enumerate(s)]
    return sorted(out)


def test_topk(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, [rng.choice((-0.5, 0.25, 0.26, 1.0)) for _ in range(4)]) for i in range(260)]
    rows += [(300, None), (350, [None, 1.0, 1.0, 1.0]), (400, [float("nan")] * 4), (450, [float("inf")] * 4), (500, [1.0]), (501, [2.0]),
             (None, [1.0] * 4), (550, []), (-50, [3e30, 3e30, 0.0, 0.0] and [3e12, 3e12, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    small = [r for r in rows if r[0] != -50]
    for tile, fan in ((2048, 64), (16, 2)):
        monkeypatch.setattr(topk_search, "TILE", tile)
        monkeypatch.setattr(topk_search, "FAN", fan)
        got = topk_search.top_k(df.where("vec_id <> -50 or vec_id is null"), 5)
        assert sorted(map(tuple, got.collect())) == brute_topk(small, 5)
    big = topk_search.top_k(df, 5).where("query_id = -50").collect()
    assert sorted(map(tuple, big)) == [x for x in brute_topk(rows, 5) if x[0] == -50]
    assert topk_search.top_k(df.limit(0), 5).count() == 0


# ---- 6 packing
def test_packing(request, empty):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(TOK)
    for df in frames(request):
        rows = df.select("doc_id", "text").collect()
        pieces = packing.pack(df, TOK).cache()
        got = pieces.collect()
        seqs = {r["sequence_id"]: r["ids"] for r in packing.sequences(pieces).collect()}
        assert sorted(seqs) == list(range(len(seqs)))
        assert all(len(v) == 2048 for s, v in seqs.items() if s != len(seqs) - 1)
        want = Counter((r["doc_id"], tuple([*own.encode(r["text"] or "", add_special_tokens=False).ids, 1])) for r in rows)
        docs, at = Counter(), defaultdict(list)
        for r in got:
            ids = np.frombuffer(r["ids"], "<u4").tolist()
            assert len(ids) == r["length"] and seqs[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == ids
            at[r["sequence_id"] * 2048 + r["offset"] - r["start"]].append((r["start"], ids, r["id"], r["doc_tokens"]))
        for parts in at.values():
            parts.sort(key=lambda p: p[0])
            ids = [x for p in parts for x in p[1]]
            assert len(ids) == parts[0][3]
            docs[parts[0][2], tuple(ids)] += 1
        assert docs == want
    assert packing.pack(empty, TOK).count() == 0


# ---- 7 near-duplicates
def brute_components(rows, width, percent):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    parent[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(doc, low.get(find(i), doc))
    return Counter((doc, len(sets[i]), low.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates(request, width, percent, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE", 4)
    for df in frames(request):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        got = near_dedup.near_duplicates(df, width=width, percent=percent).collect()
        assert Counter((r["id"], r["n_shingles"], r["component"]) for r in got) == brute_components(rows, width, percent)


def test_near_duplicates_of_drifting_families(spark, monkeypatch):
    """Texts that drift away from a base share buckets across several components."""
    monkeypatch.setattr(near_dedup, "TILE", 3)
    rng = random.Random(8)
    rows = []
    for family in range(3):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(150)]
        for member in range(25):
            own, at = list(base), rng.randint(0, 149)
            for k in range(rng.choice((0, 2, 4, 6, 9, 12))):
                own[(at + k) % 150] = f"x{family}-{member}-{k}"
            rows.append((len(rows), " ".join(own)))
    rows += [(1000 + i, rows[i][1]) for i in range(0, 75, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = near_dedup.near_duplicates(df, width=3, percent=85).collect()
    expect = brute_components(rows, 3, 85)
    assert Counter((r["id"], r["n_shingles"], r["component"]) for r in got) == expect
    assert 3 < len({c for _, _, c in expect}) < 75


@pytest.mark.parametrize("tile", [1, 2, 7, 100])
def test_tiles_bring_each_pair_across_components_together_once(spark, monkeypatch, tile):
    monkeypatch.setattr(near_dedup, "TILE", tile)
    rng = random.Random(tile)
    rows = [(key, bytes([key, node]), bytes([rng.choice((1, 1, 1, 2, 3)) if key else 1])) for key in range(3) for node in range(30)]
    df = spark.createDataFrame(rows, "key long, node binary, label binary")
    groups: dict = {}
    for r in near_dedup._tiled(df).collect():
        groups.setdefault((r["key"], r["i"], r["j"]), []).append(r)
    met = Counter()
    for members in groups.values():
        for a in (m for m in members if m["asks"]):
            for b in (m for m in members if not m["asks"]):
                if a["label"] != b["label"] and (not b["rest"] or bytes(b["node"]) > bytes(a["node"])):
                    met[frozenset((bytes(a["node"]), bytes(b["node"])))] += 1
    assert met == Counter(frozenset((a[1], b[1])) for a, b in itertools.combinations(rows, 2) if a[0] == b[0] and a[2] != b[2])


def test_wanted_texts_lose_none(spark):
    texts = spark.range(20000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("node"), F.col("id").cast("string").alias("text"))
    need = texts.where("cast(text as long) % 10 = 3").select("node")
    got = {int(r["text"]) for r in near_dedup._wanted(texts, need).select("text").collect()}
    assert set(range(3, 20000, 10)) <= got and len(got) < 2100
    assert near_dedup._wanted(texts, need.limit(0)).count() == 0


def test_salted_join_is_a_join(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    names = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    for how in ("inner", "left"):
        got = near_dedup._salted(rows, names, "k", how)
        assert Counter(map(tuple, got.select("k", "id", "name").collect())) == Counter(
            map(tuple, rows.join(names, "k", how).select("k", "id", "name").collect()))


def test_keep_one(edge, empty, docs001):
    for df in (edge, docs001):
        kept = near_dedup.keep_one(df)
        assert kept.schema == df.schema
        found = brute_components([tuple(r) for r in df.select("doc_id", "text").collect()], 5, 80)
        groups = {c for (_, n, c) in found if n}
        ids = [r["doc_id"] for r in kept.where(F.length(F.trim(F.regexp_replace("text", r"\s", ""))) > 0).collect()]
        assert sorted(ids) == sorted(groups)
        blank = sum(v for (_, n, _), v in found.items() if not n)
        assert kept.count() == len(groups) + blank
    assert near_dedup.keep_one(empty).count() == 0


def test_keep_one_tells_components_apart_by_their_texts(spark):
    say = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(None, say(0)), (None, say(1)), (None, say(1) + " end"), (None, say(1)), (5, say(2)), (5, say(3)), (5, say(3)), (9, say(2) + " end"),
            (7, say(4)), (7, say(4)), (None, ""), (3, say(5)), (5, say(5)), (None, say(6)), (8, say(6))]
    for chosen in (rows, rows[:2], rows[4:6]):      # with and without repeated rows
        kept = near_dedup.keep_one(spark.createDataFrame(chosen, "doc_id long, text string").repartition(3)).collect()
        # Each text's number, and the id that stays: the smallest of its group.
        group = lambda t: re.sub("x.*", "", t)
        want = {}
        for i, t in chosen:
            want[group(t)] = min((x for x, u in chosen if group(u) == group(t) and x is not None), default=None)
        assert sorted((group(r["text"]), str(r["doc_id"])) for r in kept) == sorted((g, str(i)) for g, i in want.items())


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b, c = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (300, 100, 100))
    left, right = np.concatenate((a, b)), np.concatenate((a, c))
    assert (near_dedup.registers(np.concatenate((left, right))) == np.maximum(near_dedup.registers(left), near_dedup.registers(right))).all()
    est = near_dedup.joint_estimate(near_dedup.registers(left)[None], near_dedup.registers(right)[None], np.array([400.0]), np.array([400.0]))
    assert abs(est[0] - 0.6) < 0.12
    for least in (0.3, est[0] - 0.01, est[0] + 0.01, 0.9):
        assert near_dedup.likely(near_dedup.registers(left)[None], near_dedup.registers(right)[None],
                                 np.array([400.0]), np.array([400.0]), least)[0] == (est[0] >= least)


def test_band_recall_is_near_one():
    rng = np.random.default_rng(3)
    miss = 0
    for _ in range(300):
        u = rng.integers(0, 2**63, 230, dtype=np.uint64)
        a, b = near_dedup.registers(u[:215]), near_dedup.registers(u[15:])
        miss += not (near_dedup.band_keys(a[None]) == near_dedup.band_keys(b[None])).any()
    assert miss == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 90), rng.randint(0, 90)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(40)]
    df = spark.createDataFrame([(bytes([0, a]), bytes([0, b])) for a, b in edges], "a binary, b binary")
    got = {r["node"][1]: r["label"][1] for r in near_dedup.components(df).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {k: got[k] for k in linked} == {x: find(x) for x in linked}


# ---- 8 quality
def brute_quality(text):
    data, w = (text or "").encode(), words(text, fold=False)
    lines = [x for x in data.split(b"\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    seen = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if seen[g] > 1 for k in range(3)}
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit))


def test_quality(request, empty):
    for df in frames(request):
        rows = df.select("doc_id", "text").collect()
        got = quality.judge(df).collect()
        want = Counter((r["doc_id"], *brute_quality(r["text"])) for r in rows)
        assert Counter(tuple(r)[:6] for r in got) == want
        assert all(not r["kept"] for r in got if r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"])
        kept = quality.keep(df)
        assert kept.schema == df.schema and kept.count() == sum(r["kept"] for r in got)
    assert quality.keep(empty).count() == 0 and quality.judge(empty).count() == 0


def test_quality_order_does_not_change_the_verdict_and_short_circuits():
    texts = [(r[1] or "").encode() for r in edge_rows()]
    for order in (quality.RULES, quality.RULES[::-1]):
        verdicts = [quality.first_failure(quality.Text(t), list(order)) is None for t in texts]
        assert verdicts == [not any(r.rejects(quality.Text(t)) for r in quality.RULES) for t in texts]
    calls = []
    rules = [quality.Rule("a", lambda t: True), quality.Rule("b", lambda t: calls.append(1) or False)]
    assert quality.first_failure(quality.Text(b"x"), rules) == "a" and calls == []
    slow = quality.Rule("slow", lambda t: sum(range(200_000)) > 0)
    fast = quality.Rule("fast", lambda t: len(t.data) > 0)
    assert [m.name for m in quality.plan([b"x"] * 20, (slow, fast))][0] == "fast"
    assert len(quality.plan([])) == len(quality.RULES)


def test_quality_keeps_clean_and_rejects_junk(spark):
    out = quality.judge(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumnRenamed("doc_id", "id"), "id").collect()
    good = [r["kept"] for r in out if r["quality"] == 1 and r["n_words"] >= 50]
    bad = [r["kept"] for r in out if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.02


# ---- 9 BPE
def test_bpe(request, empty):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(TOK)
    own.no_truncation()
    own.no_padding()
    for df in frames(request):
        want = Counter()
        for r in df.select("doc_id", "text").collect():
            ids = own.encode(r["text"] or "", add_special_tokens=False).ids
            text = own.decode(ids, skip_special_tokens=False)
            want[r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
        got = bpe.encode_decode(df, TOK, digests=True).collect()
        assert Counter((r["id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    whole = bpe.encode_decode(request.getfixturevalue("edge"), TOK).where("id = 4").first()
    assert whole["decoded"] == own.decode(whole["ids"]) and whole["ids"] == own.encode("One two", add_special_tokens=False).ids
    assert bpe.encode_decode(empty, TOK, digests=True).count() == 0


def test_bpe_random_strings():
    from tokenizers import Tokenizer
    own, mine = Tokenizer.from_file(TOK), bpe.Bpe(TOK)
    rng = random.Random(9)
    alphabet = ["a", "B", "é", "É", "×", "'", "'s", "'LL", "<|", "<|endoftext|>", " ", "\n", "\x1c", "\u0301", "=", "\u0338", "1", "２", "ß", "İ",
                "Σ", "日本", "…", ".", "!", "ᄒ", "ᅡ", "\x00", "ª", "A\u030a", "😀", "_", "-", "th", "ing", "|", "\u0085", "\u2003"]
    for _ in range(1500):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        assert mine.encode(t) == own.encode(t, add_special_tokens=False).ids, repr(t)


# ---- 10 chat
def test_chat(spark):
    rng = random.Random(6)
    turns = []
    for conv in range(60):
        n = rng.randint(1, 6)
        start = rng.randint(0, 2)
        for k in range(n):
            turns.append((conv, k, "user" if k % 2 == 0 else "assistant", f"t{start}{k if k < 4 else rng.randint(0, 2)}", "x"))
    turns += [turns[0], (90, None, None, None, "x"), (91, None, None, "", "x"), (None, 0, "user", "lost", "x"), (92, 3, "user", "b", "x"), (92, 3, "user", "a", "x")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, n_turns string")
    convs = defaultdict(set)
    for c, k, r, t, _ in turns:
        if c is not None:
            convs[c].add((k, r, t))
    order = lambda x: tuple((v is not None, v) for v in x)
    seqs = {c: tuple(x[1:] for x in sorted(v, key=lambda x: [(y is not None, y if y is not None else 0) for y in x])) for c, v in convs.items()}
    want = {}
    for c, s in seqs.items():
        if not any(len(o) > len(s) and o[:len(s)] == s for o in seqs.values()):
            first = min(d for d, o in seqs.items() if o == s)
            want[first] = (len(s), sum(o == s for o in seqs.values()),
                           "\n".join(f"<|im_start|>{r if r is not None else 'unknown'}\n{t or ''}<|im_end|>" for r, t in s))
    got = {r["conv"]: (r["n_turns"], r["n_copies"], r["text"]) for r in chat.format_chats(df).collect()}
    assert got == want and order((None,)) == ((False, None),)
    assert chat.format_chats(df.limit(0)).count() == 0


# ---- words that share a weak hash
def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


TWINS = [(thue_morse(n, "ab"), thue_morse(n, "ba")) for n in (1024, 2048, 4096)]


def collision_rows():
    """Texts of words that a polynomial hash can't tell apart, for each operator on words."""
    rows = []
    for k, (x, y) in enumerate(TWINS):
        rows += [(10 * k, f"{x} q r s {y} q r t"), (10 * k + 1, f"{x} q r"), (10 * k + 2, f"{y} q r"), (10 * k + 3, f"{x} {y}"),
                 (10 * k + 4, f"{x}'s {y}'s {x}"), (10 * k + 5, f"{y} {y} {x}")]
    return rows


@pytest.mark.parametrize("weak", [False, True])
def test_operators_tell_words_apart_that_share_a_hash(spark, monkeypatch, weak):
    if weak:    # in this process: nearly all words share a hash
        for text in [t for _, t in collision_rows()] + ["a b c d a b d c a b c", "a b", "b a", "a a b", ""]:
            buf = np.frombuffer(text.encode(), np.uint8)
            with monkeypatch.context() as m:
                m.setattr(X, "hash_spans", lambda buf, starts, ends: (ends - starts).astype(np.uint64) // 3)
                code, _ = X.words(buf, np.array([0, len(buf)])).codes()
                assert quality.Text(text.encode()).n_repeat_words == brute_quality(text)[4]
                sets = near_dedup.TextSet(text.encode(), 3)
                ids = packing.UnitEncoder(packing.LibraryUnits(TOK)).block(buf, np.array([0, len(buf)]))[0].tolist()
            w = words(text)
            assert [w.index(x) for x in w] == [w.index(w[i]) for i in [code.tolist().index(c) for c in code]]
            assert sets.set.size == len(sets.windows())
            from tokenizers import Tokenizer
            assert ids == Tokenizer.from_file(TOK).encode(text, add_special_tokens=False).ids
        return
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(TOK)
    df = spark.createDataFrame(collision_rows(), "doc_id long, text string").repartition(1)
    rows = [tuple(r) for r in df.collect()]
    ids = {i: own.encode(t, add_special_tokens=False).ids for i, t in rows}
    assert {r["id"]: r["ids"] for r in bpe.encode_decode(df, TOK).collect()} == ids
    got = defaultdict(list)
    for r in sorted(packing.pack(df, TOK).collect(), key=lambda r: (r["id"], r["start"])):
        got[r["id"]] += np.frombuffer(r["ids"], "<u4").tolist()
    assert got == {i: [*x, 1] for i, x in ids.items()}
    assert Counter(tuple(r)[:6] for r in quality.judge(df).collect()) == Counter((i, *brute_quality(t)) for i, t in rows)
    found = near_dedup.near_duplicates(df, width=3, percent=85).collect()
    assert Counter((r["id"], r["n_shingles"], r["component"]) for r in found) == brute_components(rows, 3, 85)
    count = Counter(t for i, text in rows if i % 10 in (0, 4) for t in [*words(text), "END"])
    scored = {r["id"]: r["n_known"] for r in lm_scoring.score_texts(df, lambda c: ~(F.col(c) % 10).isin(0, 4)).collect()}
    assert scored == {i: sum(count[t] > 0 for t in [*words(text), "END"]) for i, text in rows}


def test_linked_compares_words_when_hashes_agree(monkeypatch):
    say = lambda n, seed: " ".join(f"{random.Random(seed + i).randrange(10**6):x}" for i in range(n))
    base = say(60, 1)
    texts = [base, base + " tail", base.replace(" ", "\n"), say(60, 900), "p q r", "x y z", "p q", "", "p q r p q r"]
    for weak in (False, True):
        if weak:
            monkeypatch.setattr(X, "hash_spans", lambda buf, starts, ends: (ends - starts).astype(np.uint64) // 3)
        for s in texts:
            for t in texts:
                a, b = (near_dedup.TextSet(x.encode(), 3) for x in (s, t))
                x, y = a.windows(), b.windows()
                assert near_dedup._linked(a, b, 85) == (100 * len(x & y) >= 85 * len(x | y))


def test_one_word_of_50_megabytes_takes_bounded_memory():
    import tracemalloc
    data = np.frombuffer(b"ab" * (25 << 20), np.uint8)
    tracemalloc.start()
    w = X.words(data, np.array([0, len(data)]))
    w.codes()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(w.starts) == 1 and peak < 8 * len(data)


# ---- text helpers
def test_words_of_blocks():
    rng = random.Random(8)
    texts = [bytes(rng.choice(b"aB \n\t\x0b\x1c\xc3\xa9.") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    import pyarrow as pa
    for at, buf, offs in X.blocks(pa.array([*texts, None]), 100):
        w = X.words(buf, offs)
        for i in range(len(offs) - 1):
            t = texts[at + i] if at + i < len(texts) else b""
            assert [buf[s:e].tobytes() for s, e in zip(w.starts[w.first[i]:w.first[i + 1]], w.ends[w.first[i]:w.first[i + 1]])] == WORD.findall(t)
            for word, h in zip(WORD.findall(t), w.hashes[w.first[i]:w.first[i + 1]]):
                lone = np.frombuffer(word, np.uint8)
                assert X.hash_spans(X.LOWER[lone], np.array([0]), np.array([len(lone)]))[0] == h


def test_a_tidy_function_gives_the_same_batches(spark):
    from activity_lake.llm._spark import tidy

    def run(batches):
        for batch in batches:
            yield batch.slice(0, batch.num_rows - batch.num_rows % 2)

    one = pa.RecordBatch.from_pydict({"x": [1, 2, 3]})
    for batches in ([], [one], [one, one.slice(1), one.slice(3)]):
        assert list(tidy(run)(iter(batches))) == list(run(batches))
    df = spark.range(1000).repartition(4)
    assert sorted(r[0] for r in df.mapInArrow(tidy(lambda bs: bs), "id long").collect()) == list(range(1000))
