"""MinHash near-duplicates with b-bit signatures, confirmed on full shingle sets.

Of each of ``HASHES`` minima the lowest ``LOW_BITS`` bits are kept, packed into eight numbers. Two
signatures agree in a share of their places; the share that chance gives is taken off, and what is
left estimates the similarity. Candidates come from bands of ``ROWS`` whole minima. At a similarity
of 0.85 all bands miss a pair with probability 6e-11, and the estimate falls ``MARGIN`` standard
deviations short with 1e-9. What passes is confirmed on the full sets of shingles.

1. Rows with one set are a class; only classes go on, named by their smallest document.
2. Inside the task that has a band bucket, signatures are compared until it is known which classes
   hang together by estimates that pass; a spanning forest of them is handed on. The forests'
   components are clusters: no link leaves one.
3. A cluster's texts meet once, and their full sets are intersected by an inverted index inside the
   task; a spanning forest of the confirmed links is handed on, and its components are the result.

No link is lost: a pair is left out only when its ends are in one component already, or its estimate
does not pass. What is handed on is linear in the classes, however many pairs a group has. A bucket
of more than ``BUCKET_BLOCK`` classes, or a cluster of more than ``CLUSTER_BYTES`` of text, is cut
into blocks. Each block is searched by itself; then a few of each block's largest part meet, which joins
the blocks of a group of near copies; then what still hangs with nothing of the group's largest part is
met with all blocks, and with its like. So a group of near copies costs in proportion to its size, and
only rows outside its largest part go to every block.

Defined results: a null or empty text, or one without words, has an empty set and is linked with
nothing. A row without an id is linked with nothing: its component is null and it is kept. Rows of
one id are one document, linked if any of their texts is, and each has its result row. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import components, per_slice, release
from trolley.llm.text import SPACED, Texts, as_texts, mix, ragged, runs_of, slices, split_words
from trolley.session import stored

SHINGLE = 5
HASHES = 128
ROWS = 4
BANDS = HASHES // ROWS
LOW_BITS = 4
MARGIN = 6.0
BUCKET_BLOCK = 2_000
CLUSTER_BYTES = 4 << 20
#: Members of a block's largest part that stand for it when blocks are joined.
ENVOYS = 4

_LANES = HASHES * LOW_BITS // 64
_random = np.random.default_rng(20240229)
_FACTOR = _random.integers(0, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSET = _random.integers(0, 2**63, HASHES, np.uint64)
_NIBBLE = np.uint64(0x1111111111111111)
_PLACES = np.uint64(LOW_BITS) * np.arange(64 // LOW_BITS, dtype=np.uint64)


def shingle_sets(texts: Texts) -> Iterator[np.ndarray]:
    """The names of each text's distinct shingles, ascending."""
    words = split_words(texts, SPACED)
    names = words.names()
    five = runs_of(names, SHINGLE)
    for first, n in zip(words.first.tolist(), words.counts.tolist(), strict=False):
        if n >= SHINGLE:
            yield np.unique(five[first : first + n - SHINGLE + 1])
        elif n:
            # Its length goes in: a short text equals only texts of as many words.
            yield mix(runs_of(names[first : first + n], n), np.uint64(n))
        else:
            yield names[:0]


def _minima(names: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(names), 2048):
        hashed = names[None, k : k + 2048] * _FACTOR[:, None] + _OFFSET[:, None]
        least = np.minimum(least, hashed.min(axis=1))
    return least


def _signatures(rows: pa.RecordBatch) -> pa.RecordBatch:
    ids, sums, sizes, signatures, bands = rows.column("doc_id"), [], [], [], []
    seeds = np.arange(BANDS, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for names in shingle_sets(as_texts(rows.column("text"))):
            sizes.append(len(names))
            sums.append((mix(names, np.uint64(1)).sum(), mix(names, np.uint64(2)).sum()))
            if not len(names):
                signatures.append(None)
                bands.append(None)
                continue
            least = _minima(names)
            low = mix(least, np.uint64(3)) & np.uint64((1 << LOW_BITS) - 1)
            lanes = (low.reshape(_LANES, -1) << _PLACES).sum(axis=1, dtype=np.uint64)
            signatures.append(lanes.view(np.int64))
            band = runs_of(least.reshape(BANDS, ROWS).T, ROWS)[0]
            bands.append(mix(band, seeds).view(np.int64))
    first, second = np.array(sums, np.uint64).reshape(-1, 2).T.copy().view(np.int64)
    numbers = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            ids.cast(pa.int64()), pa.array(first), pa.array(second), pa.array(sizes, pa.int64()),
            pa.array(signatures, numbers), pa.array(bands, numbers),
        ],
        ["doc_id", "h1", "h2", "n_shingles", "signature", "bands"],
    )


_FEATURES = "doc_id long, h1 long, h2 long, n_shingles long, signature array<long>, bands array<long>"


def _most_differences(threshold: float) -> int:
    """The most places in which the signatures of a linked pair differ."""
    chance = 2.0**-LOW_BITS
    agree = threshold + (1 - threshold) * chance
    spread = (agree * (1 - agree) / HASHES) ** 0.5
    return int(HASHES * (1 - agree + MARGIN * spread))


def _forest(
    left: np.ndarray, right: np.ndarray | None, linked: Callable[[int, np.ndarray], np.ndarray], n: int
) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``left`` and ``right`` (within ``left`` if None).

    ``linked(k, others)`` says which of the others are linked with ``k``. Pairs whose ends hang
    together already are not asked for.
    """
    part = np.arange(n)
    found = []
    for place, k in enumerate(left.tolist()):
        others = left[place + 1 :] if right is None else right
        others = others[part[others] != part[k]]
        if not len(others):
            continue
        others = others[linked(k, others)]
        for other in others.tolist():
            if part[other] != part[k]:
                part[part == part[other]] = part[k]
                found.append((k, other))
    return found


def _groups(
    keys: tuple[str, ...], work: Callable[[pa.Table], tuple[np.ndarray, list[tuple[int, int]]]]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Run ``work`` on each group of consecutive rows of equal keys; it gives ids, and edges between
    places in them."""

    def edges(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        ids, found = work(pa.Table.from_batches(batches))
        ends = ids[np.array(found, np.int64).reshape(-1, 2)]
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tags = np.stack([batch.column(c).to_numpy() for c in keys])
            cuts = np.flatnonzero((tags[:, 1:] != tags[:, :-1]).any(axis=0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                tag = tuple(tags[:, low].tolist())
                if held and tag != now:
                    yield edges(held)
                    held = []
                now = tag
                held.append(batch.slice(low, high - low))
        if held:
            yield edges(held)
        release()

    return run


def _sides(rows: pa.Table) -> tuple[np.ndarray, np.ndarray | None]:
    """The places of the two blocks that meet."""
    part = rows.column("part").to_numpy()
    i, j = rows.column("i").to_numpy()[0], rows.column("j").to_numpy()[0]
    return np.flatnonzero(part == i), None if i == j else np.flatnonzero(part == j)


def _estimated(most: int) -> Callable[[pa.Table], tuple[np.ndarray, list[tuple[int, int]]]]:
    """Classes of a bucket that hang together by signatures with at most ``most`` differences."""

    def work(rows: pa.Table) -> tuple[np.ndarray, list[tuple[int, int]]]:
        ids = rows.column("id").to_numpy()
        numbers = rows.column("signature").combine_chunks().flatten().to_numpy()
        lanes = numbers.reshape(-1, _LANES).view(np.uint64)

        def linked(k: int, others: np.ndarray) -> np.ndarray:
            x = lanes[others] ^ lanes[k]
            for s in (1, 2):
                x |= x >> np.uint64(s)
            return np.bitwise_count(x & _NIBBLE).sum(axis=1) <= most

        return ids, _forest(*_sides(rows), linked, len(ids))

    return work


def _confirmed(percent: int) -> Callable[[pa.Table], tuple[np.ndarray, list[tuple[int, int]]]]:
    """Classes of a cluster that hang together by their full sets."""

    def work(rows: pa.Table) -> tuple[np.ndarray, list[tuple[int, int]]]:
        ids = rows.column("id").to_numpy()
        sets = []
        for batch in rows.select(["text"]).to_batches():
            for part in slices(batch, "text"):
                sets += shingle_sets(as_texts(part.column("text")))
        sizes = np.array([len(s) for s in sets], np.int64)
        names = np.concatenate(sets)
        order = np.argsort(names)
        ranked = names[order]
        owner = np.repeat(np.arange(len(sets)), sizes)[order]

        def linked(k: int, others: np.ndarray) -> np.ndarray:
            low = np.searchsorted(ranked, sets[k], "left")
            count = np.searchsorted(ranked, sets[k], "right") - low
            both = np.bincount(owner[ragged(low, count)], minlength=len(sets))[others]
            return (both > 0) & (100 * both >= percent * (sizes[k] + sizes[others] - both))

        return ids, _forest(*_sides(rows), linked, len(ids))

    return work


_PLACE = ["slot", "i", "j"]


def _sizes(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """``_parts``: how many blocks of about ``limit`` of ``weight`` a group has."""
    return rows.groupBy(key).agg(F.ceil((F.sum("weight") + 1) / limit).cast("int").alias("_parts"))


def _cut(rows: DataFrame, key: str, sizes: DataFrame) -> DataFrame:
    """Add the ``part`` of its group that a row is dealt to."""
    return rows.join(sizes, key).withColumn("part", F.expr("pmod(xxhash64(id), _parts)").cast("int"))


def _every_two(rows: DataFrame) -> DataFrame:
    """Each row in each two blocks of its group that it is one of."""
    return (
        rows.withColumn("_other", F.explode(F.expr("sequence(0, _parts - 1)")))
        .withColumns({"slot": F.lit(0), "i": F.least("part", "_other"), "j": F.greatest("part", "_other")})
        .drop("_other")
    )


def _across(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Each block of one side with each block of the other side of its group."""
    counts = [side.groupBy(key).agg(F.first("_parts").alias("_facing")) for side in (left, right)]

    def facing(side: DataFrame, other: DataFrame, number: int, slot: str) -> DataFrame:
        met = side.join(other, key).withColumn("_other", F.explode(F.expr("sequence(0, _facing - 1)")))
        return met.withColumns(
            {"slot": F.expr(slot), "part": F.lit(number), "i": F.lit(0), "j": F.lit(1)}
        ).drop("_other", "_facing")

    left = facing(left, counts[1], 0, "part + _other * _parts")
    return left.unionByName(facing(right, counts[0], 1, "_other + part * _facing"))


def _hanging_together(rows: DataFrame, key: str, sizes: DataFrame, limit: int, work: Callable) -> DataFrame:
    """Edges that hang together what ``work`` finds linked in groups of ``key``; ``rows`` have an
    ``id`` and a ``weight``, and ``sizes`` has the groups to look at."""

    def met(dealt: DataFrame) -> DataFrame:
        placed = dealt.repartition(key, *_PLACE).sortWithinPartitions(key, *_PLACE, "id")
        return placed.mapInArrow(_groups((key, *_PLACE), work), "a long, b long")

    def cut(some: DataFrame) -> DataFrame:
        return _cut(some, key, _sizes(some, key, limit))

    dealt = _cut(rows, key, sizes)
    alone = met(dealt.withColumns({"slot": F.lit(0), "i": F.col("part"), "j": F.col("part")}))
    if sizes.filter("_parts > 1").isEmpty():
        return alone
    crowded, alone = stored(dealt.filter("_parts > 1"), "crowded"), stored(alone, "edges")

    def placed(edges: DataFrame) -> DataFrame:
        found = components(edges)
        return crowded.join(found, F.col("id") == F.col("node"), "left").withColumn(
            "component", F.coalesce("component", "id")
        ).drop("node")

    # A few of each block's largest part, and of each group's.
    now = placed(alone)
    by_part = now.groupBy(key, "part", "component").agg(F.count("*").alias("_n"))
    largest = by_part.groupBy(key, "part").agg(F.max_by("component", F.struct("_n", "component")).alias("component"))
    members = now.join(largest, [key, "part", "component"])
    order = Window.partitionBy(key, "part").orderBy("id")
    envoys = members.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= ENVOYS)
    envoys = envoys.select(*rows.columns)
    edges = stored(alone.unionByName(met(_every_two(cut(envoys)))), "edges")

    now = placed(edges)
    sizes = now.groupBy(key, "component").agg(F.count("*").alias("_n"))
    main = sizes.groupBy(key).agg(F.max_by("component", F.struct("_n", "component")).alias("_main"))
    now = now.join(main, key)
    rest = stored(now.filter("component <> _main").select(*rows.columns), "rest")
    if rest.isEmpty():
        return edges
    rest, main = cut(rest), cut(now.filter("component = _main").select(*rows.columns))
    return edges.unionByName(met(_across(main, rest, key))).unionByName(met(_every_two(rest)))


def near_dedup(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row of ``docs`` (``doc_id, text``)."""
    features = stored(per_slice(docs.select("doc_id", "text"), _signatures, _FEATURES), "signatures")
    classes = stored(
        features.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("h1", "h2").agg(
            F.min("doc_id").alias("id"), F.first("signature").alias("signature"), F.first("bands").alias("bands")
        ),
        "classes",
    )
    buckets = classes.select("id", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = stored(shared.select("key", F.ceil(F.col("n") / BUCKET_BLOCK).cast("int").alias("_parts")), "shared")
    live = buckets.join(shared.select("key"), "key").join(classes.select("id", "signature"), "id")
    live = live.select("key", "id", "signature", F.lit(1).alias("weight"))
    guessed = _hanging_together(live, "key", shared, BUCKET_BLOCK, _estimated(_most_differences(percent / 100)))
    clusters = stored(components(guessed), "clusters")

    # Texts are shuffled once to find those in clusters, which then meet.
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(clusters, F.col("id") == F.col("node")).drop("node").distinct()
    texts = texts.select(F.col("component").alias("key"), "id", "text", F.octet_length("text").alias("weight"))
    texts = stored(texts, "texts")
    sizes = stored(_sizes(texts, "key", CLUSTER_BYTES), "sizes")
    links = _hanging_together(texts, "key", sizes, CLUSTER_BYTES, _confirmed(percent))
    # Classes of one document hang together.
    sets = F.struct("h1", "h2")
    mixed = features.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_mixed"))
    mixed = mixed.agg(F.min(sets).alias("_a"), F.max(sets).alias("_b")).filter("_a < _b").select("_mixed")
    mixed = stored(mixed, "mixed")
    theirs = features.filter("n_shingles > 0").join(mixed, F.col("doc_id") == F.col("_mixed"))
    theirs = theirs.select("doc_id", "h1", "h2").join(classes.select("h1", "h2", "id"), ["h1", "h2"])
    found = components(links.union(theirs.select("doc_id", "id").distinct()))

    placed = classes.join(found, F.col("id") == F.col("node"), "left").select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.coalesce("component", "id").alias("_component")
    )
    # Their rows without a word are where the document is.
    own = mixed.join(found, F.col("_mixed") == F.col("node")).select("_mixed", F.col("component").alias("_own"))
    return (
        features.join(placed, F.expr("h1 = _h1 AND h2 = _h2 AND doc_id IS NOT NULL AND n_shingles > 0"), "left")
        .join(own, F.expr("doc_id = _mixed AND n_shingles = 0"), "left")
        .selectExpr("doc_id", "n_shingles", "coalesce(_component, _own, doc_id) AS component_id")
        .withColumn("kept", F.expr("doc_id <=> component_id"))
    )
