"""Operators that relate documents, learned scores, archives, and the pipeline."""

import base64
import gzip
import hashlib
import random
import tracemalloc

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.conftest import DOCS, odd_rows, rows_of, sentence
from trolley.llm import common, near_dedup as near_module, substring_dedup as cut_module, warc
from trolley.llm.near_dedup import near_dedup
from trolley.llm.quality_classifier import classify
from trolley.llm.queries import QUERIES
from trolley.llm.substring_dedup import cut_substrings, substring_dedup
from trolley.llm.toxicity import score_toxicity

LABELS = "doc_id long, quality int, toxic int"


def test_substrings(spark, documents, odd, monkeypatch):
    for docs in (documents, odd.filter("doc_id IS NULL OR doc_id <> 7")):
        expected = brute.without_substrings([(r.doc_id, r.text) for r in docs.collect()])
        assert rows_of(substring_dedup(docs)) == sorted(expected, key=repr)
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdé ") for _ in range(300)) for _ in range(6)]
    rows = []
    for i in range(100):
        parts = [b[rng.randint(0, 150) : rng.randint(150, 300)] if rng.random() < 0.7 else "ab" * rng.randint(0, 60) for b in base[:3]]
        rows.append((i * 7 % 100, rng.choice(["".join(parts)] * 9 + ["x" * 200])))
    monkeypatch.setattr(cut_module, "BLOCK_BYTES", 2_000)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(substring_dedup(docs)) == sorted(brute.without_substrings(rows), key=repr)
    # One shuffle of the texts, read by all passes.
    plan = cut_substrings(docs, ["doc_id"])._jdf.queryExecution().toString()
    assert plan.count("Scan ExistingRDD") >= 1


def test_substrings_of_rows_without_ids_and_of_one_id(spark, monkeypatch):
    """They are dealt over all blocks, and neither lose bytes to their like nor keep others' from going."""
    rng = random.Random(8)
    rows = [(i, sentence(rng, 30)) for i in range(60)]
    rows += [(None, rows[i % 60][1] + sentence(rng, 3)) for i in range(120)]
    rows += [(70, rows[i][1][20:] + rows[0][1]) for i in range(60)]
    rows += [(None, None)] * 60 + [(80, rows[5][1])] * 60
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).localCheckpoint()
    held = cut_module._dealt(docs, ["doc_id"], 8).groupBy("id", "block").count().collect()
    for i in (None, 70, 80):
        sizes = [r["count"] for r in held if r.id == i]
        assert len(sizes) == 8 and max(sizes) < sum(sizes) / 3
    monkeypatch.setattr(cut_module, "BLOCK_BYTES", 2_000)
    cut = substring_dedup(docs)
    assert rows_of(cut) == sorted(brute.without_substrings(rows), key=repr)


def near_rows():
    rng = random.Random(7)
    rows = []
    for g in range(12):
        base = sentence(rng, rng.randint(40, 200)).split()
        for _ in range(rng.randint(1, 9)):
            words = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 5))):
                words[rng.randrange(len(words))] = sentence(rng, 1) + "q"
            rows.append(" ".join(words))
    # Chains: neighbours are linked, ends are not.
    words = sentence(rng, 150).split()
    for k in range(8):
        words[10 + 12 * k] = f"w{k}"
        rows.append(" ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


def test_near_duplicates(spark, documents, monkeypatch):
    for rows in ([(r.doc_id, r.text) for r in documents.collect()], near_rows()):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        expected = brute.near(rows)
        assert sum(not r[3] for r in expected) > 3
        assert rows_of(near_dedup(docs)) == sorted(expected, key=repr)
    # The same with blocks of two in the buckets and of a text or two in the clusters.
    monkeypatch.setattr(near_module, "BUCKET_BLOCK", 2)
    monkeypatch.setattr(near_module, "CLUSTER_BYTES", 2_000)
    assert rows_of(near_dedup(docs)) == sorted(expected, key=repr)


def test_near_duplicates_of_odd_rows(odd):
    found = {}
    for r in near_dedup(odd).collect():
        found.setdefault(r.doc_id, set()).add((r.component_id, r.kept))
    assert found[1] == {(1, True)} and found[2] == {(1, False)} and found[3] == {(1, False)}
    assert found[None] == {(None, True)} and found[4] == {(4, True)} and found[6] == {(6, True)}
    assert found[10] == {(10, True)} and found[11] == {(10, False)}


def test_near_duplicates_of_one_id_with_several_texts(spark):
    rng = random.Random(9)
    a, b, c = (sentence(rng, 120) for _ in range(3))
    near_b = b.rsplit(" ", 1)[0] + " zzz"
    rows = [(5, a), (5, b), (5, ""), (3, a), (7, near_b), (8, c), (8, " "), (9, c), (10, sentence(rng, 120))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.component_id, r.kept) for r in near_dedup(docs).collect())
    assert found == [
        (3, 3, True), (5, 3, False), (5, 3, False), (5, 3, False), (7, 3, False),
        (8, 8, True), (8, 8, True), (9, 8, False), (10, 10, True),
    ]


def test_estimates_correct_for_chance():
    rng = np.random.default_rng(4)
    shared, own = rng.integers(0, 2**63, 900, np.uint64), rng.integers(0, 2**63, (2, 50), np.uint64)
    least = [near_module._minima(np.append(shared, o)) for o in own]
    low = [near_module.mix(m, np.uint64(3)) & np.uint64(15) for m in least]
    agree = (low[0] == low[1]).mean()
    assert (agree - 1 / 16) / (15 / 16) == pytest.approx(0.9, abs=0.1)
    assert 128 * (1 - 0.859) < near_module._most_differences(0.85) < 48


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 340)]
    found = dict(map(tuple, common.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    assert found == {n: root(n) for e in edges if e[0] != e[1] for n in e}


PAGES = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>one</p>"),
    (3, "http://a/\r\n3", None),
    (4, None, ""),
    (5, "http://a/5", "é\r\n\r\nWARC/1.1\r\n" * 3),
    (5, "http://a/5", "é\r\n\r\nWARC/1.1\r\n" * 3),
    (None, "http://a/6", "<p>one</p>"),
    (None, "http://a/7", "alone"),
    (8, "http://a/8", "long " * 200_000),
]


def test_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, payload_bytes int")
    found = rows_of(warc.round_trip(pages, str(tmp_path), 2_000).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    expected = []
    for page, _, html in PAGES:
        payload = (html or "").encode()
        ids = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        refers = max(ids) if ids and max(ids) != page else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        expected.append((page, len(payload), digest, "response" if refers is None else "revisit", refers))
    assert found == sorted(expected, key=repr)
    # The written files are what they should be: one stream, then a member per record.
    streams, members = list((tmp_path / "streams").glob("*.gz")), list((tmp_path / "members").glob("*.gz"))
    assert len(streams) == len(members) > 1
    assert sorted(gzip.decompress(p.read_bytes()) for p in streams) == sorted(gzip.decompress(p.read_bytes()) for p in members)
    for path in members:
        data = path.read_bytes()
        for line in path.with_name(path.name + ".idx").read_text().splitlines():
            offset, length, name, *_ = line.split("\t")
            record = gzip.decompress(data[int(offset) : int(offset) + int(length)])
            assert record.startswith(b"WARC/1.1\r\n") and name.encode() in record and record.endswith(b"\r\n\r\n")


def test_a_cut_archive_is_noticed():
    record = warc.make_record(1, "u", b"x" * 99, 99, "D", None)
    assert list(warc.inflated_records(iter([gzip.compress(record * 2)]))) == [record] * 2
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.inflated_records(iter([gzip.compress(record + record[:50])])))


def test_archives_from_elsewhere(spark, tmp_path):
    """Other types, odd headers, missing digests, hexadecimal ones, blank lines and padded members."""
    body = b"HTTP/1.1 200 OK\r\ncontent-type:text/html\r\nX-Folded: a\r\n\tb\r\n\r\n<p>h\xc3\xa9</p>"
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Type: application/warc-fields\r\nContent-Length: 9\r\n\r\nsoft: own"
    lower = b"WARC/1.1\r\nwarc-type:response\r\nwarc-record-id:<urn:uuid:2>\r\nwarc-target-uri: http://x/\r\n y\r\ncontent-type:application/http; msgtype=response\r\ncontent-length:%d\r\n\r\n%b" % (len(body), body)
    hexed = lower.replace(b"<urn:uuid:2>", b"<urn:uuid:3>\r\nWARC-Payload-Digest: sha1:" + hashlib.sha1(b"x").hexdigest().encode())
    seen = b"WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:uuid:4>\r\nContent-Length: 0\r\n\r\n"
    end = b"\r\n\r\n"
    stream = gzip.compress(info + end + b"\r\n" + lower + end) + b"\0" * 7 + gzip.compress(hexed + end + seen + end + b"\r\n\r\n")
    (tmp_path / "foreign.warc.gz").write_bytes(stream)
    archives = spark.createDataFrame([(f"file://{tmp_path}/foreign.warc.gz", 4, 0)], "archive string, records long, bytes long")
    rows = {r.record_id: r for r in warc.read_records(warc.normalise(archives, f"file://{tmp_path}/out")).collect()}
    payload = base64.b32encode(hashlib.sha1("<p>hé</p>".encode()).digest()).decode()
    found = {k: (r.record_type, r.payload_bytes, r.payload_digest, r.page_id) for k, r in rows.items()}
    assert found == {
        "<urn:uuid:1>": ("warcinfo", 9, base64.b32encode(hashlib.sha1(b"soft: own").digest()).decode(), None),
        "<urn:uuid:2>": ("response", 10, payload, None),
        "<urn:uuid:3>": ("response", 10, payload, None),
        "<urn:uuid:4>": ("revisit", None, None, None),
    }
    assert rows["<urn:uuid:2>"].url == "http://x/ y"


def test_inflating_holds_a_record_and_a_chunk():
    record = warc.make_record(1, "u", b"x" * 100_000, 100_000, "D", None)
    stream = gzip.compress(record * 1_500)
    tracemalloc.start()
    assert sum(len(r) for r in warc.inflated_records(iter([stream]))) == 1_500 * len(record)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(record) * 1_500 > 140 << 20 and peak < 12 << 20


def labelled(spark):
    rng = random.Random(11)
    bad = ["awfulnet", "grimble", "vorkish"]
    docs, labels = [], []
    for i in range(700):
        words = sentence(rng, rng.randint(30, 120)).split()
        toxic, quality = int(rng.random() < 0.2), int(rng.random() < 0.7)
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(bad) + rng.choice(("", "s", "ing")) for _ in range(rng.randint(2, 5))]
        if not quality:
            words = [w + rng.choice(("###", "!!", "|")) for w in words]
        docs.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, quality, toxic))
    labels += [(None, 1, 1), (3, 0, 0), (3, 1, 1), (5, None, None), (99_999, 1, 0)]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), labels


def test_learned_scores_on_rows_held_out(spark):
    docs, labels, known = labelled(spark)
    for result, column, folds, which in ((classify(docs, labels), 1, 5, 0), (score_toxicity(docs, labels), 2, 4, 2)):
        rows = result.select("doc_id", "held_out", "score", "predicted").collect()
        assert len(rows) == 700 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
        assert all(r.held_out == brute.held_out(r.doc_id, folds, which) for r in rows)
        truth = {r[0]: r[column] for r in known[:700]}
        held = [r for r in rows if r.held_out]
        assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.93 * len(held)


def test_toxic_passages_are_where_the_words_are(spark):
    docs, labels, _ = labelled(spark)
    text = dict(docs.select("doc_id", "text").collect())
    right = []
    for r in score_toxicity(docs, labels).filter("n_found > 0").collect():
        for begin, end in zip(r.passages[::2], r.passages[1::2], strict=True):
            passage = text[r.doc_id].encode()[begin:end]
            right.append(any(w in passage for w in (b"awfulnet", b"grimble", b"vorkish")))
    assert len(right) > 100 and sum(right) >= 0.95 * len(right)


def test_scores_without_labels(spark, odd):
    none = spark.createDataFrame([], LABELS)
    for result in (classify(odd, none), score_toxicity(odd, none)):
        rows = result.select("doc_id", "held_out", "score").collect()
        assert len(rows) == len(odd_rows()) and {round(r.score, 6) for r in rows} == {0.5}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_of_odd_and_empty_tables(spark, tmp_path, odd, empty, name):
    """No odd row is lost, and empty tables give empty results."""
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1), (None, None, None)], LABELS)
    items = spark.createDataFrame([(1, "one two"), (None, None)], "item_id long, text string")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    for folder, docs in (("odd", odd), ("empty", empty)):
        part = docs if folder == "odd" else docs.limit(0)
        part.write.parquet(str(tmp_path / folder / "documents.parquet"))
        for table, df in (("labels", labels), ("benchmark", items), ("pages", pages)):
            (df if folder == "odd" else df.limit(0)).write.parquet(str(tmp_path / folder / f"{table}.parquet"))
    assert QUERIES[name](spark, str(tmp_path / "empty")).count() == 0
    found = QUERIES[name](spark, str(tmp_path / "odd")).collect()
    if name.startswith("op2_"):
        assert len(found) == len(PAGES)
    elif name.startswith("op12_"):
        assert {(r.part, r.value) for r in found} == {("pair", 0)}
    elif name.startswith(("op6_", "op9_")):
        assert {r.doc_id for r in found} == {r[0] for r in odd_rows()}
    else:
        assert sorted((r.doc_id for r in found), key=repr) == sorted((r[0] for r in odd_rows()), key=repr)
