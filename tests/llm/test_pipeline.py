"""The pipeline against brute force, stage by stage, and on awkward rows."""
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from activity_lake.llm import queries, quality, toxicity

from .test_operators import brute_components, words

SF = "/root/testdata/sf0.001"


def _key(rows, columns=("doc_id", "text", "lang", "source", "n_chars")):
    return Counter(tuple(r[c] for c in columns) for r in rows)


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "near_duplicates", "packing"]


def test_pipeline_matches_brute_force(spark):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    want = [r for r in rows if not any(rule.rejects(quality.Text((r["text"] or "").encode())) for rule in quality.RULES)]
    one = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert one.schema == docs.schema and _key(one.collect()) == _key(want)

    net = toxicity.train(one, spark.read.parquet(f"{SF}/labels.parquet"), queries.toxic_held_out)
    score = lambda t: net.score_block(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0]
    want = [r for r in want if score(r["text"]) < net.threshold(r["lang"])]
    two = corpus_pipeline.STAGES[1][1](spark, one, SF)
    assert two.schema == docs.schema and _key(two.collect()) == _key(want)

    keep = {c for (_, n, c) in brute_components([(r["doc_id"], r["text"]) for r in want], 5, 80) if n}
    want = [r for r in want if r["doc_id"] in keep or not words(r["text"])]
    three = corpus_pipeline.STAGES[2][1](spark, two, SF)
    assert three.schema == docs.schema and _key(three.collect()) == _key(want)

    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    four = corpus_pipeline.run(spark, SF).collect()
    ids = {r["doc_id"]: [*own.encode(r["text"], add_special_tokens=False).ids, 1] for r in want}
    found = {}
    for r in sorted(four, key=lambda r: (r["doc_id"], r["start"])):
        found.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert found == ids


@pytest.mark.parametrize("which", ["edge", "empty"])
def test_each_stage_on_awkward_rows(spark, request, which):
    docs = request.getfixturevalue(which)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.schema == docs.schema
            assert not (_key(out.collect()) - _key(docs.collect()))
        elif which == "edge":
            assert sum(r["begins"] for r in out.collect()) == docs.count()
        else:
            assert out.count() == 0


def test_registered_queries_and_oracles():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert {"op1_shard_interleave", "op2_url_filter", "op5_topk_tiles", "op7_setsketch_dedup", "op8_quality_cascade",
            "op10_chat_collapse"} <= set(__spark_entry__.oracle_sql())
