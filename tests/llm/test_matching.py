"""Aligned vocabularies, source divergence and SimHash against straightforward versions."""

import random

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.conftest import odd_rows, rows_of, sentence
from trolley.llm import common, simhash_dedup as simhash_module, source_divergence as divergence_module
from trolley.llm import token_alignment as alignment_module
from trolley.llm.simhash_dedup import PIVOTS, distance_table, masks, simhash_dedup
from trolley.llm.source_divergence import source_divergence
from trolley.llm.text import as_texts
from trolley.llm.token_alignment import align, encoded, pair_counts, vocabulary_paths

ODD_TEXTS = ["\u2581x", "a" * 30_000, " " * 3000 + "b", "\U0001f600\u65e5\u672c" * 2000, "\u200b\ufeff\r\n\t x ", " ", "x\u2581 y", "<s>\x00</s>"]


def test_alignment(spark, documents, odd, monkeypatch):
    extra = [(100 + n, t, "en", "s", 1, True, 5, "x", 7.5, 1, 2) for n, t in enumerate(ODD_TEXTS)]
    odd = odd.union(spark.createDataFrame(extra, odd.schema))
    for docs in (documents, odd):
        expected = brute.aligned([(r.doc_id, r.text) for r in docs.collect()])
        assert rows_of(align(docs)) == sorted(expected, key=repr)
    # The same with many shards, and with all groups multiplied out by distinct ids.
    monkeypatch.setattr(alignment_module, "SHARD_POSTINGS", 50)
    monkeypatch.setattr(alignment_module, "LISTED", 0)
    assert rows_of(align(odd)) == sorted(expected, key=repr)


def test_pair_counts(spark):
    texts = ["the cat", "the cat the the the the", "the dog", "the cat the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    postings = encoded(docs, vocabulary_paths()).filter("pair IS NOT NULL")
    found = sorted((r.n_docs, r.n_links) for r in pair_counts(postings).collect())
    assert found == [(1, 1), (3, 3), (4, 9)]


def test_divergence(spark, odd, empty, monkeypatch):
    rng = random.Random(4)
    vocabulary = [sentence(rng, 1) for _ in range(60)] + ["É", "é", "longerthaneight", "longerthaneightandmore", "longerth"]
    rows = list(odd.select("lang", "source", "text").toLocalIterator())
    for _ in range(900):
        lang, source = rng.choice(("en", "en", None, "de", "")), rng.choice(("a", "b", None, "", "c", "A", "é"))
        words = rng.choices(vocabulary, k=rng.randint(0, 12)) + [source or "none"] * rng.randint(0, 2)
        rows.append((lang, source, rng.choice((" ", "1", "\n")).join(words) or None))
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumns(
        {"doc_id": common.F.lit(1), "value": common.F.lit(2), "term": common.F.lit("x")}
    )
    expected = sorted(brute.divergence([tuple(r) for r in rows]))
    assert {r[2] for r in expected} == {"pair", "term"}
    assert sorted(map(tuple, source_divergence(docs).collect())) == expected
    # The same with small shards, words a few at a time and sources in blocks.
    monkeypatch.setattr(divergence_module, "SHARD_BYTES", 500)
    monkeypatch.setattr(divergence_module, "WORDS", 2)
    monkeypatch.setattr(divergence_module, "SOURCES", 3)
    assert sorted(map(tuple, source_divergence(docs).collect())) == expected
    # Too few documents for any word: pairs of value zero.
    small = source_divergence(odd).collect()
    assert small and {(r.part, r.value) for r in small} == {("pair", 0)}
    assert source_divergence(empty).count() == 0


def test_simhash(spark, documents, odd):
    for docs in (documents, odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        prints = {r.doc_id: brute.simhash(r.text) for r in docs.collect()}
        components = brute.within(prints)
        expected = [(d, format(p, "016x"), components[d]) for d, p in prints.items()]
        assert rows_of(simhash_dedup(docs)) == sorted(expected, key=repr)
    found = simhash_dedup(odd).collect()
    assert len(found) == len(odd_rows()) and {r.component_id for r in found if r.doc_id is None} == {None}


def test_simhash_of_one_id_with_several_texts(spark):
    rng = random.Random(9)
    a, b, c = (sentence(rng, 120) for _ in range(3))
    rows = [(5, a), (5, b), (3, a), (7, b), (8, c), (8, c), (9, "")]
    found = simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(3, 3), (5, 3), (5, 3), (7, 3), (8, 8), (8, 8), (9, 9)]


@pytest.mark.parametrize(("block", "most"), [(4096, 64), (16, 64), (16, 4)])
def test_links_of_crowded_buckets(spark, monkeypatch, block, most):
    """Balls of many fingerprints: met in one block, block by block, and dealt again by more bits."""
    monkeypatch.setattr(simhash_module, "BLOCK", block)
    monkeypatch.setattr(simhash_module, "MOST_BLOCKS", most)
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = [rng.getrandbits(64) for _ in range(100)]
    for _ in range(700):
        p = rng.choice(centres)
        for bit in rng.sample(range(64), rng.randint(0, 9)):
            p ^= 1 << bit
        prints.append(p)
    prints = dict(enumerate(dict.fromkeys(prints)))
    expected = brute.within(prints)
    assert 100 < len(set(expected.values())) < len(prints) - 100
    classes = spark.createDataFrame([(k, simhash_module._signed(p)) for k, p in prints.items()], "id long, bits long")
    found = {r.node: r.component for r in common.components(simhash_module.links(classes)).collect()}
    assert {k: found.get(k, k) for k in prints} == expected


def test_buckets_and_pivots_lose_no_link():
    rng = random.Random(2)
    first = masks(0, 6)
    assert len(first) == 15 and len(masks(first[0], 8)) == 70
    for _ in range(300):
        x = rng.getrandbits(64)
        bits = rng.sample(range(64), rng.randint(0, 40))
        y = x
        for bit in bits:
            y ^= 1 << bit
        table = distance_table(np.array([x, y], np.uint64)).astype(int)
        gap = np.abs(table[0] - table[1]).max()
        if len(bits) <= 4:
            assert gap <= 4 and any((x ^ y) & m == 0 for m in first)
        if len(bits) > 16:
            assert gap > 4
    # A crowded bucket's finest buckets hold no more different fingerprints than a block.
    finest = [64 - m.bit_count() for a in first[:2] for b in masks(a, 8)[:5] for m in masks(b, 8)]
    assert 2 ** max(finest) <= 4096 and len(set(PIVOTS.tolist())) == 64


def test_fingerprints_of_no_texts():
    assert len(simhash_module.fingerprints(as_texts(alignment_module.pa.array([], "string")))) == 0
