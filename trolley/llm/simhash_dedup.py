"""SimHash near-duplicates: buckets of equal bits, pivot distance tables inside them.

A fingerprint's bit is set if it is set in over half of the hashes of the text's 4-word shingles.
Fingerprints that differ in at most ``ERRORS`` bits are linked.

1. Rows with one fingerprint are a class; only classes go on, named by their smallest document.
2. Of 6 pieces of the bits, two fingerprints with 4 differences have 2 in common: a class goes to the 15
   buckets of equal pairs of pieces, and linked classes meet in one of them.
3. In a bucket the Hamming distances of its fingerprints to ``PIVOTS`` are tabled first. By the triangle
   inequality linked ones differ by at most 4 in each distance: pairs with a larger difference in any
   coordinate are discarded, what survives is verified bit by bit. The pivots are the rows of a
   Sylvester matrix: the squares of a pair's 64 differences add up to 64 times its distance, so no pair
   further apart than 16 survives. A search from class to class over those not reached yet hands on a
   spanning forest, never all pairs; the forests' components are the result.

A bucket of up to ``MOST_BLOCKS`` blocks of ``BLOCK`` classes is met block by block, every two in a task
of their own. The classes of a larger one are dealt again by more equal bits (4 of 8 pieces of those
left), twice at most: then no more than ``BLOCK`` different fingerprints are possible in a bucket. So a
class is copied a fixed number of times, however large its bucket is.

Defined results: a text that is null, empty or without words has the fingerprint zero, which is linked
like any other. A row without an id is linked with nothing: its component is null. Rows of one id are
one document, linked if any of their texts is, and each has its result row. An empty table gives an
empty result. A text of any length is hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import components, per_slice
from trolley.llm.text import SPACED, Texts, as_texts, ragged, split_words
from trolley.session import stored

SHINGLE = 4
SEED = 42
BITS = 64
ERRORS = 4
#: Pieces the bits are cut into, first of all bits and then of those that are left.
PIECES = (6, 8, 8)
BLOCK = 4096
MOST_BLOCKS = 64
#: Classes of a bucket up to which its pairs are looked at together with those of other buckets.
SMALL = 32
#: Classes of small buckets looked at together.
_TOGETHER = 20_000

#: Bit ``j`` of reference fingerprint ``i`` is the parity of ``i & j``.
PIVOTS = np.array([sum((i & j).bit_count() % 2 << j for j in range(BITS)) for i in range(BITS)], np.uint64)


def shingle_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all texts' shingles end to end, and how many each has."""
    import xxhash

    words = split_words(texts, SPACED)
    # The words with one blank after each.
    place = np.cumsum(words.size + 1) - (words.size + 1)
    spaced = np.full(int((words.size + 1).sum()), ord(" "), np.uint8)
    spaced[ragged(place, words.size)] = words.folded[ragged(words.start, words.size)]
    stop = place + words.size
    counts = np.where(words.counts > 0, np.maximum(words.counts - SHINGLE + 1, 1), 0)
    first = ragged(words.first[:-1], counts)
    last = first + np.repeat(np.minimum(words.counts, SHINGLE) - 1, counts)
    raw = spaced.tobytes()
    spans = zip(place[first].tolist(), stop[last].tolist(), strict=True)
    hashes = np.fromiter((xxhash.xxh64_intdigest(raw[a:b], SEED) for a, b in spans), np.uint64, len(first))
    return hashes, counts


def fingerprints(texts: Texts) -> np.ndarray:
    hashes, counts = shingle_hashes(texts)
    made = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    heads = (np.cumsum(counts) - counts)[full]
    if len(full):
        for bit in range(BITS):
            ones = np.add.reduceat((hashes >> np.uint64(bit) & np.uint64(1)).astype(np.int64), heads)
            made[full] |= (2 * ones > counts[full]).astype(np.uint64) << np.uint64(bit)
    return made


def _prints(rows: pa.RecordBatch) -> pa.RecordBatch:
    made = fingerprints(as_texts(rows.column("text"))).view(np.int64)
    return pa.RecordBatch.from_arrays([rows.column("doc_id").cast(pa.int64()), pa.array(made)], ["doc_id", "bits"])


def masks(taken: int, pieces: int) -> list[int]:
    """The bits of ``taken`` and of all but ``ERRORS`` of the pieces the others are cut into."""
    free = [b for b in range(BITS) if not taken >> b & 1]
    parts = [sum(1 << int(b) for b in part) for part in np.array_split(free, pieces)]
    return [taken | sum(chosen) for chosen in combinations(parts, pieces - ERRORS)]


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def distance_table(prints: np.ndarray) -> np.ndarray:
    """Distances to each pivot."""
    return np.bitwise_count(prints[:, None] ^ PIVOTS).astype(np.int8)


def _survivors(table: np.ndarray, prints: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the pairs ``x[k], y[k]`` are linked: by pivots, a few at a time, and then verified."""
    left = np.arange(len(x))
    for low, high in ((1, 2), (2, 8), (8, 24), (24, BITS)):
        far = np.abs(table[x[left], low:high] - table[y[left], low:high]).max(axis=1, initial=0)
        left = left[far <= ERRORS]
    return left[np.bitwise_count(prints[x[left]] ^ prints[y[left]]) <= ERRORS]


def _forest(prints: np.ndarray, left: np.ndarray, right: np.ndarray | None) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``left`` and ``right`` (within ``left`` if None)."""
    table = distance_table(prints)
    # Who is not reached yet, on either side.
    waiting = [left, left if right is None else right]
    found = []
    while len(waiting[0]):
        pending = [(int(waiting[0][0]), 0)]
        waiting[0] = waiting[0][1:]
        if right is None:
            waiting[1] = waiting[0]
        while pending:
            k, side = pending.pop()
            other = 0 if right is None else 1 - side
            near = _survivors(table, prints, np.full(len(waiting[other]), k), waiting[other])
            if not len(near):
                continue
            reached = waiting[other][near]
            waiting[other] = np.delete(waiting[other], near)
            pending += [(int(r), other) for r in reached]
            found += [(k, int(r)) for r in reached]
    return found


def _small(prints: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of consecutive small buckets."""
    ends = np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(len(prints))
    after = ends - at - 1
    x, y = np.repeat(at, after), ragged(at + 1, after)
    linked = _survivors(distance_table(prints), prints, x, y)
    return x[linked], y[linked]


_KEYS = ("mask", "key", "i", "j")


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of buckets, whose rows are consecutive."""

    def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def work(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        tags = np.stack([columns[c] for c in _KEYS])
        heads = np.flatnonzero(np.append(True, (tags[:, 1:] != tags[:, :-1]).any(axis=0)))
        sizes = np.diff(np.append(heads, tags.shape[1]))
        ids, prints = columns["id"], columns["bits"].view(np.uint64)
        alike = columns["i"][heads] == columns["j"][heads]
        few = (sizes > 1) & (sizes <= SMALL) & alike
        rows = ragged(heads[few], sizes[few])
        if len(rows):
            x, y = _small(prints[rows], sizes[few])
            yield edges(ids[rows][x], ids[rows][y])
        for k in np.flatnonzero((sizes > 1) & ~few).tolist():
            mine = slice(heads[k], heads[k] + sizes[k])
            part = columns["part"][mine]
            left = np.flatnonzero(part == columns["i"][heads[k]])
            right = None if alike[k] else np.flatnonzero(part == columns["j"][heads[k]])
            found = np.array(_forest(prints[mine], left, right), np.int64).reshape(-1, 2)
            yield edges(ids[mine][found[:, 0]], ids[mine][found[:, 1]])

    names = (*_KEYS, "part", "id", "bits")
    held: list[dict[str, np.ndarray]] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append({c: batch.column(c).to_numpy() for c in names})
        size += batch.num_rows
        if size < _TOGETHER:
            continue
        now = {c: np.concatenate([h[c] for h in held]) for c in names}
        # The last bucket may go on.
        last = np.logical_and.reduce([now[c] == now[c][-1] for c in _KEYS])
        yield from work({c: v[~last] for c, v in now.items()}) if not last.all() else ()
        held, size = [{c: v[last] for c, v in now.items()}], 0
    if held:
        yield from work({c: np.concatenate([h[c] for h in held]) for c in names})


def _meeting(rows: DataFrame) -> DataFrame:
    """Each bucket's rows in blocks, and in each two blocks that must meet."""
    return (
        rows.withColumn("_parts", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("part", F.expr("pmod(xxhash64(id), _parts)").cast("int"))
        .withColumn("_other", F.explode(F.expr("sequence(0, _parts - 1)")))
        .withColumns({"i": F.least("part", "_other"), "j": F.greatest("part", "_other")})
        .select(*_KEYS, "part", "id", "bits")
        .repartition(*_KEYS)
        .sortWithinPartitions(*_KEYS, "id")
    )


def links(classes: DataFrame) -> DataFrame:
    """``a, b``: links that hang together what fingerprints within ``ERRORS`` bits do (``id, bits``)."""
    spark = classes.sparkSession
    taken, found = [0], None
    rows = classes.withColumn("mask", F.lit(0).cast("long"))
    for level, pieces in enumerate(PIECES):
        finer = [(t, m) for t in taken for m in masks(t, pieces)]
        taken = sorted({m for _, m in finer})
        if level == 0:
            rows = rows.withColumn("mask", F.explode(F.array(*[F.lit(_signed(m)) for m in taken])))
        else:
            # A table of fixed size.
            steps = spark.createDataFrame([(_signed(t), _signed(m)) for t, m in finer], "mask long, _finer long")
            rows = rows.join(F.broadcast(steps), "mask").select("id", "bits", F.col("_finer").alias("mask")).distinct()
        rows = rows.withColumn("key", F.expr("bits & mask"))
        sizes = rows.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
        rows = stored(rows.join(sizes, ["mask", "key"]), "buckets")
        last = level == len(PIECES) - 1
        limit = BLOCK * MOST_BLOCKS
        made = _meeting(rows if last else rows.filter(F.col("n") <= limit)).mapInArrow(_linked, "a long, b long")
        found = made if found is None else found.union(made)
        if last:
            break
        rows = rows.filter(F.col("n") > limit).select("id", "bits", "mask")
        if rows.isEmpty():
            break
    return found


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row of ``docs`` (``doc_id, text``)."""
    prints = stored(per_slice(docs.select("doc_id", "text"), _prints, "doc_id long, bits long"), "fingerprints")
    known = prints.filter("doc_id IS NOT NULL")
    classes = stored(known.groupBy("bits").agg(F.min("doc_id").alias("id")), "classes")
    # Classes of one document hang together.
    mixed = known.groupBy(F.col("doc_id").alias("_mixed")).agg(F.min("bits").alias("_a"), F.max("bits").alias("_b"))
    theirs = known.join(mixed.filter("_a < _b"), F.col("doc_id") == F.col("_mixed")).select("doc_id", "bits")
    theirs = theirs.join(classes, "bits").select(F.col("doc_id").alias("a"), F.col("id").alias("b")).distinct()
    found = components(links(classes).union(theirs))
    placed = classes.join(found, F.col("id") == F.col("node"), "left").select(
        F.col("bits").alias("_bits"), F.coalesce("component", "id").alias("_component")
    )
    return prints.join(placed, F.expr("bits = _bits AND doc_id IS NOT NULL"), "left").selectExpr(
        "doc_id", "lower(lpad(hex(bits), 16, '0')) AS fingerprint", "_component AS component_id"
    )
