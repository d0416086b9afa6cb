"""The rounds of repeated passages work on a part of their bytes at a time, with the results of the whole."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from trolley.llm import substring_dedup as module


def bucket(records, sent_bytes):
    """Rows of the second round: ``records`` is ``{block: [(short, whole, doc)]}``, and each pair's bytes
    come with its first record in order of documents and blocks."""
    first = {}
    for block, rows in records.items():
        for short, whole, doc in rows:
            first[short, whole] = min(first.get((short, whole), (doc, block)), (doc, block))
    made = []
    for block, rows in records.items():
        short, whole, docs = (np.array(c, k) for c, k in zip(zip(*rows), (np.uint64, np.uint64, np.int64)))
        packed = module._pack(short, whole, module._narrow(docs, int(docs.min())))
        sent = [(i, sent_bytes[r[:2]]) for i, r in enumerate(rows) if first[r[:2]] == (r[2], block)]
        index = np.array([(i, len(d)) for i, d in sent], np.uint32).reshape(-1, 2)
        made.append([0, block, int(docs.min()), len(rows), packed, index.tobytes(), b"".join(d for _, d in sent)])
    kinds = [*module._RECORD_KINDS, pa.binary(), pa.binary()]
    return pa.Table.from_batches([module._rows(made, [*module._RECORD_NAMES, "sent", "bytes"], kinds)])


def segments_of_one_rank(rng, ranks, most, long=84):
    """Pairs with their bytes (of a few long texts a rank, so that strings are shared), and records."""
    sent_bytes, records = {}, {b: {} for b in range(3)}
    for rank in range(ranks):
        base = bytes(rng.choice(b"abcd") for _ in range(160))
        for k in range(rng.randint(1, most)):
            size = rng.randint(module.LENGTH, long)
            begin = rng.randint(0, len(base) - size)
            pair = rank, (k + 1) << 16
            sent_bytes[pair] = base[begin : begin + size]
            for block in rng.sample(range(3), rng.randint(1, 3)):
                records[block][pair] = rng.randint(0, 40)
    return {b: [(*p, d) for p, d in r.items()] for b, r in records.items()}, sent_bytes


@pytest.mark.parametrize("part", [1, 200, 1_000, 1 << 19])
def test_second_round_by_parts(monkeypatch, part):
    records, sent_bytes = segments_of_one_rank(random.Random(5), 40, 9)
    least, expected = {}, {}
    strings = {p: [d[i : i + module.LENGTH] for i in range(len(d) - module.LENGTH + 1)] for p, d in sent_bytes.items()}
    every = [(block, *row) for block, rows in records.items() for row in rows]
    for _, short, whole, doc in every:
        for string in strings[short, whole]:
            least[short, string] = min(doc, least.get((short, string), doc))
    for block, short, whole, doc in every:
        mask = sum((least[short, s] < doc) << i for i, s in enumerate(strings[short, whole]))
        if mask:
            expected[block, short, whole] = mask
    monkeypatch.setattr(module, "PART_BYTES", part)
    answers = module._second_round(bucket(records, sent_bytes)).to_pylist()
    found = {
        (row["block"], int(s), int(w)): int(m)
        for row in answers
        for s, w, m in zip(*module._unpack(row["data"], row["n"]))
    }
    assert len(expected) > 50 and found == expected


def peak(work, *given):
    tracemalloc.start()
    try:
        work(*given)
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_second_round_holds_names_of_a_part():
    rng = random.Random(6)
    records, sent_bytes = segments_of_one_rank(rng, 12_000, 9)
    size = sum(map(len, sent_bytes.values()))
    assert size > 7 * module.PART_BYTES
    # What it needs for every record, and some 80 bytes a byte of a part.
    n = sum(map(len, records.values()))
    assert peak(module._second_round, bucket(records, sent_bytes)) < 2 * size + 200 * n + 80 * module.PART_BYTES


def test_block_holds_names_of_a_part():
    rng = np.random.default_rng(7)
    texts = [rng.integers(97, 123, 2_000, np.uint8).tobytes().decode() for _ in range(1_000)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(1_000), pa.int64()), pa.array(texts)], ["id", "text"])
    assert peak(module._Block, rows) < 12 * 2_000_000 + 80 * module.PART_BYTES
