"""Operators on one text at a time against straightforward versions."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tests.llm.conftest import odd_rows, rows_of
from trolley.llm import licenses, quality_rules, token_counts, toxicity, trees
from trolley.llm.decontamination import decontaminate
from trolley.llm.packing import pack, vocabulary_paths
from trolley.llm.text import SPACED, as_texts, split_words
from trolley.llm.tokens import Vocabulary

ITEMS = [(1, "One two"), (2, None), (None, "three"), (3, ""), (3, "line of text line of text line of text line of")]


@pytest.fixture(scope="module")
def words():
    return Vocabulary(*vocabulary_paths())


def texts_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def odd_texts():
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "a", "bc", "'s", "'", "é", "1", "..", "\t", "日", "\r\n", "B", "!", " ", " ", "\x1c", "à"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    return [*made, "", " ", "a ", " a", "<|endoftext|>x", "it's we'll", "a\n\n\nb", "x" * 5000]


def test_words_are_those_of_the_pattern():
    texts = odd_texts()
    found = split_words(as_texts(pa.array(texts)), SPACED)
    expected = [w.encode() for t in texts for w in brute.SPACED.findall(t.translate(brute.LOW))]
    assert [found.word(i) for i in range(len(found.start))] == expected


def test_token_ids_are_the_tokenizers(words, documents):
    texts = odd_texts() + [t for _, t in texts_of(documents)]
    for k in range(0, len(texts), 400):
        some = texts[k : k + 400]
        flat, counts = words.ids(as_texts(pa.array(some)))
        expected = words._slow.encode_batch(some, add_special_tokens=False)
        ends = np.cumsum(counts)
        for text, end, n, encoding in zip(some, ends, counts, expected, strict=True):
            assert flat[end - n : end].tolist() == encoding.ids, repr(text[:50])


def test_base_rules(documents, odd):
    for docs in (documents, odd):
        rows = docs.select("text").toArrow().column("text")
        found = quality_rules.base_counts(as_texts(rows))
        for i, text in enumerate(rows.to_pylist()):
            if len(text or "") < 20_000:
                assert tuple(int(v[i]) for v in found.values()) == brute.base_rules(text), text


def test_model_is_a_distribution(spark, documents):
    """Probabilities of all symbols after a context add up to one, unless hashes meet."""
    docs = documents.filter("lang = 'en'").limit(30)
    model = quality_rules.train(docs)
    text = as_texts(pa.array(["the thing on hand"]))
    keys, _ = quality_rules.grams(text)
    totals = []
    for key in keys.tolist():
        after = np.array([(key >> 6 << 6) | s for s in range(64)], np.uint32)
        totals.append(np.exp(model.log_probabilities(after, "en")).sum())
    assert np.median(totals) == pytest.approx(1, abs=0.01)


def test_perplexity_rejects_noise_and_keeps_prose(spark):
    rng = random.Random(3)

    def prose(n):
        return " ".join(rng.choice(["the", "cat", "sat", "on", "mats", "while", "dogs", "slept"]) + "." * (i % 9 == 0) for i in range(n))

    def noise(n):
        return " ".join("".join(rng.choice("qxzjkvw#0897") for _ in range(rng.randint(2, 9))) for _ in range(n))

    rows = [(i, prose(rng.randint(80, 200)), "en") for i in range(120)]
    rows += [(1000 + i, noise(120), "en") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert not any(found[1000 + i].kept for i in range(3))
    passed = [r for r in found.values() if r.doc_id < 1000 and not r.base_failed]
    assert sum(r.kept for r in passed) >= 0.97 * len(passed)


def test_a_language_of_copies_keeps_its_documents(spark, documents):
    """Copies make up nine tenths of a language; neither they nor the others are cut for it."""
    rows = [(r.doc_id, r.text, "en") for r in documents.filter("lang = 'en'").collect()]
    alone = {r.doc_id: r.kept for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    text = next(t for d, t, _ in rows if alone[d])
    rows += [(10_000_000 + i, text, "en") for i in range(9 * len(rows))]
    random.Random(4).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    assert quality_rules.distinct_texts(docs).count() == len({t for _, t, _ in rows})
    found = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert {d: r.kept for d, r in found.items() if d < 10_000_000} == alone
    copies = [r for d, r in found.items() if d >= 10_000_000]
    assert all(r.kept for r in copies) and len({r.log_perplexity for r in copies}) == 1


def test_scores_are_those_of_a_plain_model(spark, monkeypatch):
    """Every n-gram counts with its own probability, whether it is held by the workers or joined."""
    rng = random.Random(11)
    words = ["the", "Cat", "sat", "on", "mats", "été", "日本語", "12", "(so)"]

    def text(noise):
        made = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz.,!#é日\n", k=6)) if rng.random() < noise else rng.choice(words) for _ in range(80)]
        return " ".join(made)

    rows = [(i, text(rng.random()), rng.choice(["en", "de", None])) for i in range(200)]
    rows += [(1000, rows[0][1], rows[0][2]), (1001, rows[0][1], "xx"), (1002, None, "en"), (1003, "", None), (None, "a", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    expected = brute.perplexities([(t, lang) for _, t, lang in rows], quality_rules._KIND)
    made = []
    for held in (None, 500, 0):
        if held is not None:
            monkeypatch.setattr(quality_rules, "HELD_MODEL", held)
        found = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
        for doc, t, lang in rows:
            assert found[doc].log_perplexity == (pytest.approx(expected[lang, t], rel=1e-6) if t else None)
        assert found[0].log_perplexity == found[1000].log_perplexity
        made.append({d: r.kept for d, r in found.items()})
    assert made[0] == made[1] == made[2]


def test_decontamination(spark, documents, odd):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    expected = brute.decontaminated(texts_of(documents), items)
    assert any(r[-1] for r in expected)
    assert rows_of(decontaminate(documents, benchmark).select(*columns)) == sorted(expected, key=repr)
    small = spark.createDataFrame(ITEMS, "item_id long, text string")
    for block_bytes in (1 << 20, 20):
        found = decontaminate(odd, small, block_bytes=block_bytes).select(*columns)
        assert rows_of(found) == sorted(brute.decontaminated(texts_of(odd), ITEMS), key=repr)


def test_packing_is_whole_and_gapless(words, documents, odd):
    for docs, window in ((documents, 1024), (odd, 64)):
        pieces = pack(docs, window, keep_ids=True).collect()
        sequences, whole = {}, {}
        for p in pieces:
            assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length > 0
            sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
            place = p.sequence_id * window + p.offset - p.start
            whole.setdefault((p.doc_id, place), []).append((p.start, bytes(p.ids), p.doc_tokens))
        for n, parts in sequences.items():
            ends = [0, *[a + b for a, b in sorted(parts)]]
            assert ends[:-1] == [a for a, _ in sorted(parts)]
            assert ends[-1] == window or n == max(sequences)
        assert sorted(sequences) == list(range(len(sequences)))
        found = []
        for (doc, _), parts in whole.items():
            ids = np.frombuffer(b"".join(b for _, b, _ in sorted(parts)), "<u4")
            assert {n for _, _, n in parts} == {len(ids)}
            found.append((doc, ids.tolist()))
        expected = [(d, words.encode([t or ""])[0] + [0]) for d, t in texts_of(docs)]
        assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_section_tokens(words, documents, odd):
    """Every token counts once, for the section that holds most of it."""
    for docs in (documents.limit(60), odd):
        found = {}
        for r in token_counts.section_token_counts(docs).collect():
            found.setdefault(r.doc_id, set()).add(tuple(r[1:]))
        expected = {}
        for doc, text in texts_of(docs):
            text = text or ""
            starts = [0] + [i + 1 for i, c in enumerate(text[:-1]) if c == "\n"]
            ends = [*starts[1:], len(text)]
            counts, shared = [0] * len(starts), [0] * len(starts)
            for begin, end in words._slow.encode(text, add_special_tokens=False).offsets if len(text) < 9999 else []:
                held = [max(0, min(end, b) - max(begin, a)) for a, b in zip(starts, ends, strict=True)]
                best = held.index(max(held))
                counts[best] += 1
                shared[best] += sum(h > 0 for h in held) > 1
            rows = {(n, a, b - a, c, s) for n, (a, b, c, s) in enumerate(zip(starts, ends, counts, shared, strict=True))}
            expected.setdefault(doc, set()).update(rows)
            if len(text) >= 9999:
                expected[doc], found[doc] = {len(starts)}, {len(found[doc])}
        assert found == expected


def test_tokens_across_a_boundary():
    begin, end = np.array([0, 4, 9, 12]), np.array([4, 9, 12, 30])
    # Five characters over a boundary after three, a tie, and a token over four sections.
    chosen, crosses = token_counts.allocate(begin, end, np.array([0, 7, 14, 16, 25]))
    assert chosen.tolist() == [0, 0, 1, 3] and crosses.tolist() == [False, True, False, True]
    chosen, _ = token_counts.allocate(np.array([0]), np.array([4]), np.array([0, 2]))
    assert chosen.tolist() == [0]


def test_field_tokens(spark, words):
    rows = [("a", "System: ", "say hi", None), ("b", "", "", "tail"), (None, None, None, None)]
    records = spark.createDataFrame(rows, "id string, role string, body string, end string")
    found = {r.id: r.n_tokens for r in token_counts.field_token_counts(records, "id", ["role", "body", "end"]).collect()}
    assert found["b"] == [0, 0, len(words.encode(["tail"])[0])] and found[None] == [0, 0, 0]
    assert sum(found["a"]) == len(words.encode(["System: say hi"])[0])


def test_licences(spark):
    three = "bsd-grant bsd-source bsd-binary bsd-names".split()
    full = "Foo.\n\n" + ".\n  ".join(licenses.SENTENCES[i].replace(" ", "\n", 3) for i in three) + "."
    rows = [
        (1, full),
        (2, "; ".join(licenses.SENTENCES[i].upper() for i in three[:3])),
        (3, "some prose without an end\nReleased under the MIT License.\nMore; and more"),
        (4, "; ".join(licenses.SENTENCES[i] for i in reversed(three[:3]))),
        (5, None),
        (None, ""),
        (6, "Licensed under the Apache License, Version 2.0. This work is licensed under the GNU General Public License, version 3."),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, licences string")
    found = {r.doc_id: (r.licences, r.n_licence_sentences) for r in licenses.scan_licences(docs).collect()}
    assert found == {
        1: ("BSD-3-Clause", 4), 2: ("BSD-2-Clause", 3), 3: ("MIT", 1), 4: ("", 3), 5: ("", 0), None: ("", 0),
        6: ("Apache-2.0,GPL-3.0", 2),
    }


_GNU = """    This {0} is free software{1} you can redistribute it and/or modify
    it under the terms of the GNU {2}General Public License as published by
    the Free Software Foundation{3} either version {4} of the License, or
    (at your option) any later version.

    This {0} is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU {2}General Public License for more details.
"""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL ...
"""
_BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
"""
#: Standard notices, verbatim, with the licence of each.
NOTICES = [
    (_APACHE, "Apache-2.0"),
    (
        _APACHE + """You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions.""",
        "Apache-2.0",
    ),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("#!/bin/sh\n# SPDX-License-Identifier: Apache-2.0\necho a", "Apache-2.0"),
    (_MIT, "MIT"),
    ("Released under the MIT License.", "MIT"),
    ("Licensed under the MIT License.", "MIT"),
    ("// SPDX-License-Identifier: MIT\nint a;\n", "MIT"),
    ("/* SPDX-License-Identifier: GPL-3.0-or-later */\nint a;\n", "GPL-3.0"),
    (
        "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby "
        "granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
        "ISC",
    ),
    (_BSD, "BSD-2-Clause"),
    (
        _BSD + "\n3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse "
        "or promote products derived from\n   this software without specific prior written permission.\n",
        "BSD-3-Clause",
    ),
    (_GNU.format("program", ":", "", ",", "3"), "GPL-3.0"),
    (_GNU.format("program", ";", "", ";", "3"), "GPL-3.0"),
    (_GNU.format("program", ";", "", ";", "2"), "GPL-2.0"),
    (_GNU.format("library", ";", "Lesser ", ";", "2.1"), "LGPL-2.1"),
    (_GNU.format("program", ":", "Lesser ", ",", "3"), "LGPL-3.0"),
    (_GNU.format("program", ":", "Affero ", ",", "3"), "AGPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    (
        "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL "
        "was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */",
        "MPL-2.0",
    ),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    ("Licensed under CC0 1.0.", "CC0-1.0"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    # Pieces that do not stand side by side, or stand alone, are nothing.
    ("SPDX-License-Identifier: BSD-3-Clause\nMIT\n", ""),
    ("MIT. Apache-2.0; 2.0", ""),
]


def test_standard_notices(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NOTICES)], "doc_id long, text string")
    found = {r.doc_id: r.licences for r in licenses.scan_licences(docs).collect()}
    assert [(t, found[i]) for i, (t, _) in enumerate(NOTICES)] == NOTICES
    assert {name for _, name in NOTICES} >= {name for name, _ in licenses.RULES + licenses.FORM_RULES}


def test_maximal_segments_are_the_definitions():
    """A segment is maximal if no other that overlaps it scores higher; found by brute force."""
    rng = random.Random(2)

    def split(scores, low, high):
        best = max(((sum(scores[a:b]), -(b - a), -a) for a in range(low, high) for b in range(a + 1, high + 1)), default=(0,))
        if best[0] <= 0:
            return []
        a = -best[2]
        b = a - best[1]
        return split(scores, low, a) + [(a, b, best[0])] + split(scores, b, high)

    for _ in range(150):
        scores = [rng.choice((-3, -2, -1, 1, 2, 4)) for _ in range(rng.randint(0, 14))]
        found = toxicity.maximal_segments(np.array(scores, float))
        assert [s for _, _, s in found] == [s for _, _, s in split(scores, 0, len(scores))], scores


def test_trees_learn_an_interaction_and_flat_arrays_are_trees():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(3000, 5))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 3] > 0.5)).astype(float)
    forest = trees.fit(rows[:2000], labels[:2000], trees=40)
    assert ((forest.score(rows[2000:]) > 0.5) == labels[2000:]).mean() > 0.95
    row = rows[2500]
    total = forest.start
    for feature, threshold, leaf in zip(forest.features, forest.thresholds, forest.leaves, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        total += leaf[node - len(feature)]
    assert forest.score(row[None])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_digest_of_nothing():
    assert brute.decontaminated([(1, None)], [])[0][4] == hashlib.sha256(b"").hexdigest()
    assert len(odd_rows()) == 15


def test_passages_against_a_plain_version(documents):
    """Words one at a time, bytes counted by hand."""
    table = np.random.default_rng(3).normal(-0.4, 1.2, 1 << toxicity.HASH_BITS).astype(np.float32)
    chance = toxicity.Chance(0.7, 0.2, 4.0)
    scores = {}

    def score(word):
        if word not in scores:
            slot, _, _ = toxicity.slots_of(as_texts(pa.array([word])))
            scores[word] = float(toxicity.word_scores(slot, table)[0])
        return scores[word]

    text = {r.doc_id: r.text or "" for r in documents.collect()}
    some = 0
    for r in toxicity.find_passages(documents.select("doc_id", "text"), table, chance).collect():
        words = list(brute.ALNUM.finditer(text[r.doc_id].translate(brute.LOW)))
        begins = [len(text[r.doc_id][: w.start()].encode()) for w in words] + [len(text[r.doc_id].encode())]
        found = toxicity.maximal_segments(np.array([score(w.group()) for w in words]))
        gains = [0.7 * s - math.log(len(words)) - math.log(0.2) for _, _, s in found]
        strong = [(begins[a], begins[b]) for (a, b, _), g in zip(found, gains, strict=True) if g >= 4.0]
        some += len(strong)
        assert (r.n_words, r.n_found) == (len(words), len(strong))
        assert r.passages == [x for span in strong for x in span]
        assert r.best == pytest.approx(max([-10.0, *gains])) and r.total == pytest.approx(sum(g for g in gains if g >= 4.0))
    assert some > 50


def test_chance_is_what_clean_texts_give():
    """Segments no rarer than stated among the texts it is taken from, and among others like them."""
    rng = np.random.default_rng(5)

    def texts():
        words = [rng.normal(-0.8, 1.0, rng.integers(20, 400)) for _ in range(4000)]
        best = [max((s for _, _, s in toxicity.maximal_segments(w)), default=0.0) for w in words]
        return np.concatenate(words), np.array([len(w) for w in words], float), np.array(best)

    every, words, best = texts()
    values, times = np.unique(np.round(every, 2), return_counts=True)
    chance = toxicity.chance_of(values, times, words, best)
    assert chance.rate == pytest.approx(1.6, rel=0.1) and chance.need >= -np.log(toxicity.EXPECTED)
    assert (chance.surprise(best, words)[best > 0] >= chance.need).sum() <= toxicity.EXPECTED * 4000
    _, words, best = texts()
    assert (chance.surprise(best, words)[best > 0] >= chance.need).mean() < 2 * toxicity.EXPECTED
