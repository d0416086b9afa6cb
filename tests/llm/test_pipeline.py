"""The stages one by one on odd tables, and as a whole."""

import math
import random

import pytest

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import rows_of, sentence
from trolley.llm import quality_rules


def test_stages_keep_columns_and_survive_odd_tables(spark, tmp_path, odd, empty):
    spark.createDataFrame([(1, "one two"), (None, None)], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, docs, str(tmp_path))
            assert made.schema.simpleString() == docs.schema.simpleString(), name
            rows, given = rows_of(made), rows_of(docs)
            if name == "repeated_passages":
                assert len(rows) == len(given)
            else:
                assert set(rows) <= set(given)
            if not given:
                continue
            ids = [r[0] for r in rows]
            if name == "near_duplicates":
                assert 1 in ids and not {2, 3, 11} & set(ids) and ids.count(None) == 2
            if name == "benchmark_texts":
                assert not {10, 11} & set(ids) and len(rows) == len(given) - 2
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= docs.count()


def test_run_is_the_stages_in_order(spark, documents):
    folder = "/root/testdata/sf0.001"
    docs = documents
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, folder).cache()
        kept.append(docs.count())
        if name == "near_duplicates":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert {r.doc_id for r in docs.collect()} == {r[0] for r in brute.near(rows) if r[3]}
        if name == "repeated_passages":
            expected = {r[0]: r[1] - r[2] for r in brute.without_substrings([(r.doc_id, r.text) for r in before.collect()])}
            assert all(len(r.text.encode()) in range(expected[r.doc_id] - 99, expected[r.doc_id] + 1) for r in docs.collect())
            assert all(r.n_chars == len(r.text) for r in docs.collect())
    assert kept == sorted(kept, reverse=True) and kept[-1] > kept[0] / 2
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}


@pytest.mark.parametrize("held", [None, 2000])
def test_rules_keep_what_a_plain_model_keeps(spark, monkeypatch, held):
    """Texts with more and more noise: those at the edge of the band are told apart as by exact scores."""
    if held is not None:
        monkeypatch.setattr(quality_rules, "HELD_MODEL", held)
    rng = random.Random(12)

    def noisy(share):
        words = sentence(rng, 120).split()
        return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) if rng.random() < share else w for w in words)

    texts = [noisy(0.02) for _ in range(400)] + [noisy(i / 1000) for i in range(200)]
    assert len(set(texts)) == len(texts)
    scores = brute.perplexities([(t, "en") for t in texts], quality_rules._KIND)
    ranked = sorted(scores.values())
    first, third = (ranked[math.ceil(len(ranked) * q) - 1] for q in (0.25, 0.75))
    reach = quality_rules.REACH * max(third - first, quality_rules.LEAST_SPREAD)
    expected = {i for i, t in enumerate(texts) if first - reach <= scores["en", t] <= third + reach}
    assert 450 < len(expected) < 590
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    kept = corpus_pipeline.quality_rules(spark, docs.repartition(3), "").collect()
    assert {r.doc_id for r in kept} == expected and len(kept) == len(expected)
