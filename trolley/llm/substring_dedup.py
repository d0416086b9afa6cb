"""Exact substring removal: every 50-byte string that also starts in an earlier document goes.

Prefix doubling on a synchronised sample of positions. A position's rank is the name (fingerprint)
of what follows it, and names of longer prefixes are made of pairs of names at growing offsets:
8 -> 16 -> 32 -> 50 bytes. Of all positions only those take part in sorting that carry the smallest
16-byte name of a 50-byte string; equal strings choose alike, so none is lost, and about one
position in eighteen is left. Consecutive strings with one choice form a segment of at most 84
bytes, which is ranked by the pair (16-byte name, name of the whole segment):

1. Spark sorts the (16, whole) rank pairs. A pair that no other block of documents has is done. A
   segment whose 16-byte rank has no other segment is wholly decided by its smallest document.
2. Where one 16-byte rank has several segments, their bytes are gathered and reranked at the full
   50 bytes, string by string.
3. The decisions return to the blocks, which mark the bytes.

Rows are dealt to blocks one by one, so neither rows without an id nor those of one id gather in one;
documents are compared by id, wherever their rows are. A block sends each distinct pair once, with its smallest
document, so a passage in a third of all documents is a row per block wherever it is counted.

Deviation from textbook prefix doubling, and why: sorting every byte position at every offset moves
some sixteen bytes a position and round, ten times the input and more each time.

Defined results: a null text is empty; nothing is removed from it. A row without an id neither
loses bytes nor counts for others. Rows of one id are one document: none counts against another.
An empty table gives an empty result. A document of any length is worked on as a whole by one task.
"""

from __future__ import annotations

from collections.abc import Iterator
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import carrying, release
from trolley.llm.text import Texts, as_texts, eights, mix, ragged, slices

LENGTH = 50
FIRST = 16
REACH = LENGTH - FIRST + 1
#: Bytes of text in a block.
BLOCK_BYTES = 12 << 20
#: Bytes worked on at once: every one takes some sixty while strings are named.
PART_BYTES = 1 << 19

_RECORDS = "bucket int, block int, base long, n int, data binary"
_ALL = np.uint64((1 << REACH) - 1)
_SEVERAL = np.uint64(1 << 63)
_SENDS = np.uint64(1 << 62)
_BIT = np.arange(REACH, dtype=np.uint64)
_BIT_AT = np.uint64(1) << _BIT


def _smallest(names: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive names, by doubling."""
    least, reach = names, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _full_names(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the 16 and of the 50 bytes from each position on (zeros beyond the end)."""
    n = len(data)
    eight = eights(data, LENGTH + 8)
    sixteen = mix(eight[: n + LENGTH - 8], eight[8 : n + LENGTH])
    thirty_two = mix(sixteen[: n + 18], sixteen[16 : n + 34])
    return sixteen[:n], mix(thirty_two[:n], thirty_two[18 : n + 18])


def segments(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of 50-byte strings, 16-byte rank and segment rank of all segments."""
    counts = np.maximum(texts.sizes - LENGTH + 1, 0)
    start = ragged(texts.offsets[:-1], counts)
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    sixteen, fifty = _full_names(texts.data)
    least = _smallest(sixteen, REACH)[start]
    fresh = np.append(True, (least[1:] != least[:-1]) | (start[1:] != start[:-1] + 1))
    # Texts follow each other without a gap; a new text is a new segment.
    fresh[(np.cumsum(counts) - counts)[counts > 0]] = True
    heads = np.flatnonzero(fresh)
    sizes = np.diff(np.append(heads, len(start)))
    # Runs of one choice (periodic text) are cut into segments of at most REACH strings.
    parts = -(-sizes // REACH)
    nth = ragged(np.zeros(len(parts), np.int64), parts)
    first = start[np.repeat(heads, parts)] + nth * REACH
    held = np.minimum(np.repeat(sizes, parts) - nth * REACH, REACH)
    short = least[np.repeat(heads, parts)]
    # The first and the last 50 bytes cover the segment.
    whole = mix(fifty[first], fifty[first + held - 1] + held.astype(np.uint64))
    return first, held, short, whole


def _keys(short: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """A segment's rank pair as one number, for looking up within a block."""
    return (whole >> np.uint64(16) << np.uint64(16)) | (short & np.uint64(0xFFFF))


def _pack(short: np.ndarray, whole: np.ndarray, last: np.ndarray) -> bytes:
    """Rank pairs (32 and 48 bits) and a number each; equal-typed columns one after another."""
    high = whole >> np.uint64(16)
    return b"".join(
        [
            short.astype(np.uint32).tobytes(),
            (high >> np.uint64(32)).astype(np.uint16).tobytes(),
            high.astype(np.uint32).tobytes(),
            last.tobytes(),
        ]
    )


def _unpack(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    short = np.frombuffer(data, np.uint32, n).astype(np.uint64)
    upper = np.frombuffer(data, np.uint16, n, 4 * n).astype(np.uint64)
    lower = np.frombuffer(data, np.uint32, n, 6 * n).astype(np.uint64)
    kind = np.uint32 if len(data) == 14 * n else np.uint64
    return short, (upper << np.uint64(48)) | (lower << np.uint64(16)), np.frombuffer(data, kind, n, 10 * n)


def _narrow(numbers: np.ndarray, base: int) -> np.ndarray:
    gaps = (numbers - base).astype(np.uint64)
    return gaps.astype(np.uint32) if not len(gaps) or gaps.max() < 1 << 32 else gaps


class _Block:
    """A block's segments, with the smallest document of each rank pair."""

    def __init__(self, rows: pa.Table | pa.RecordBatch) -> None:
        self.rows = []
        found = []
        for batch in rows.to_batches() if isinstance(rows, pa.Table) else [rows]:
            for part in slices(batch, "text", PART_BYTES):
                texts = as_texts(part.column("text"))
                start, held, short, whole = segments(texts)
                ids = part.column("id")
                known = np.array(ids.is_valid())
                owner = texts.owner(start)
                mine = known[owner]
                start, held, short, whole, owner = (x[mine] for x in (start, held, short, whole, owner))
                docs = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[owner]
                self.rows.append((part, texts, start, held, docs, len(start)))
                found.append((short, whole >> np.uint64(16) << np.uint64(16), docs))
        full, whole, docs = (
            [np.concatenate(c) for c in zip(*found, strict=True)]
            if found
            else [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)]
        )
        del found
        keys = _keys(full, whole)
        self.pairs, self.first, self.place = np.unique(keys, return_index=True, return_inverse=True)
        self.smallest = np.full(len(self.pairs), np.iinfo(np.int64).max)
        np.minimum.at(self.smallest, self.place, docs)
        full = full[self.first]
        self.short, self.whole, self.buckets = full & np.uint64(0xFFFFFFFF), whole[self.first], full >> np.uint64(32)


def _alike(tags: np.ndarray) -> list[np.ndarray]:
    """The places of each tag."""
    order = np.argsort(tags, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(tags[order])) + 1) if len(order) else []


def _send(bucket: np.ndarray, block: int, short: np.ndarray, whole: np.ndarray, docs: np.ndarray) -> Iterator[list]:
    """A row per bucket of the pairs that go there."""
    for chosen in _alike(bucket):
        base = int(docs[chosen].min())
        packed = _pack(short[chosen], whole[chosen], _narrow(docs[chosen], base))
        yield [int(bucket[chosen[0]]), block, base, len(chosen), packed]


def _rows(rows: list[list], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


_RECORD_NAMES = ["bucket", "block", "base", "n", "data"]
_RECORD_KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]


def _records(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Rank pairs, documents and blocks of all rows of a bucket."""
    parts = []
    for block, base, n, data in zip(
        *(table.column(c).to_pylist() for c in ("block", "base", "n", "data")), strict=True
    ):
        short, whole, gaps = _unpack(data, n)
        parts.append((short, whole, gaps.astype(np.int64) + base, np.full(n, block, np.int64)))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _answers(block: np.ndarray, short: np.ndarray, whole: np.ndarray, mask: np.ndarray) -> pa.Table:
    rows = []
    for chosen in _alike(block):
        rows.append([int(block[chosen[0]]), len(chosen), _pack(short[chosen], whole[chosen], mask[chosen])])
    batch = _rows(rows, ["block", "n", "data"], [pa.int32(), pa.int32(), pa.binary()])
    return pa.Table.from_batches([batch])


_ANSWERS = "block int, n int, data binary"


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Number the groups of equal keys of sorted rows."""
    fresh = np.zeros(len(keys[0]), bool)
    if len(fresh):
        fresh[0] = True
        for key in keys:
            fresh[1:] |= key[1:] != key[:-1]
    return np.cumsum(fresh) - 1


def _decisions(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Blocks, rank pairs and masks of the segments of a bucket that are decided or whose bytes are called for."""
    short, whole, docs, block = _records(table)
    order = np.lexsort((docs, whole, short))
    short, whole, docs, block = short[order], whole[order], docs[order], block[order]
    by_short, by_pair = _groups(short), _groups(short, whole)
    opens = np.flatnonzero(np.append(True, by_pair[1:] != by_pair[:-1]))
    least = docs[opens]
    heads = np.flatnonzero(np.append(True, by_short[1:] != by_short[:-1]))
    kinds = np.bincount(by_short[opens])
    lowest = np.minimum.reduceat(docs, heads)
    highest = np.maximum.reduceat(docs, heads)
    several = ((kinds > 1) & (lowest != highest))[by_short]
    sends = np.zeros(len(docs), bool)
    sends[opens] = True
    later = least[by_pair] < docs
    mask = np.where(several, _SEVERAL | np.where(sends, _SENDS, np.uint64(0)), _ALL)
    chosen = several | later
    return block[chosen], short[chosen], whole[chosen], mask[chosen]


def _first_round(table: pa.Table) -> pa.Table:
    """Decide the segments whose 16-byte rank has no other segment; call for the bytes of others."""
    made = _answers(*_decisions(table))
    release()
    return made


def _runs(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Consecutive items of at most ``most`` in all; a larger one is a run of its own."""
    ends = np.cumsum(sizes)
    first = done = 0
    while first < len(ends):
        stop = max(first + 1, int(np.searchsorted(ends, done + most, "right")))
        yield slice(first, stop)
        first, done = stop, int(ends[stop - 1])


def _string_names(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Names of all 50-byte strings of some spans of ``data``, end to end."""
    made = []
    for run in _runs(size, PART_BYTES):
        sizes = size[run]
        _, fifty = _full_names(data[ragged(start[run], sizes)])
        made.append(fifty[ragged(np.cumsum(sizes) - sizes, sizes - LENGTH + 1)])
    return np.concatenate(made)


def _earliest(names: np.ndarray, group: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Per string, the smallest document of its group that has it."""
    order = np.lexsort((names, group))
    string = _groups(group[order], names[order])
    heads = np.flatnonzero(np.append(True, string[1:] != string[:-1]))
    made = np.empty_like(docs)
    made[order] = np.minimum.reduceat(docs[order], heads)[string]
    return made


def _second_round(table: pa.Table) -> pa.Table:
    """Rerank the strings of segments that share a 16-byte rank, some ranks at a time."""
    short, whole, docs, block = _records(table)
    order = np.lexsort((docs, whole, short))
    short, whole, docs, block = short[order], whole[order], docs[order], block[order]
    by_short, by_pair = _groups(short), _groups(short, whole)
    opens = np.flatnonzero(np.append(True, by_pair[1:] != by_pair[:-1]))
    least, rank = docs[opens], by_short[opens]
    # Each pair's bytes came once, with its smallest document.
    at, sizes, done = [], [], 0
    for n, sent in zip(*(table.column(c).to_pylist() for c in ("n", "sent")), strict=True):
        places = np.frombuffer(sent, np.uint32)
        at.append(done + places[0::2].astype(np.int64))
        sizes.append(places[1::2].astype(np.int64))
        done += n
    number = np.empty(len(order), np.int64)
    number[order] = by_pair
    size = np.concatenate(sizes)
    start = np.cumsum(size) - size
    order = np.argsort(number[np.concatenate(at)])
    size, start = size[order], start[order]
    data = as_texts(table.column("bytes")).data
    mask = np.zeros(len(docs), np.uint64)
    for run in _runs(np.bincount(rank, size).astype(np.int64), PART_BYTES):
        pairs = slice(*np.searchsorted(rank, [run.start, run.stop]).tolist())
        records = slice(*np.searchsorted(by_short, [run.start, run.stop]).tolist())
        counts = size[pairs] - LENGTH + 1
        names = _string_names(data, start[pairs], size[pairs])
        earliest = _earliest(names, np.repeat(rank[pairs], counts), np.repeat(least[pairs], counts))
        mask[records] = _earlier(docs[records], by_pair[records] - pairs.start, counts, earliest)
    chosen = mask > 0
    made = _answers(block[chosen], short[chosen], whole[chosen], mask[chosen])
    release()
    return made


def _earlier(docs: np.ndarray, pair: np.ndarray, counts: np.ndarray, earliest: np.ndarray) -> np.ndarray:
    """Per record, which strings of its segment an earlier document has."""
    begin = np.cumsum(counts) - counts
    made = np.zeros(len(docs), np.uint64)
    for run in _runs(counts[pair], PART_BYTES):
        held = counts[pair[run]]
        later = earliest[ragged(begin[pair[run]], held)] < np.repeat(docs[run], held)
        bits = np.where(later, _BIT_AT[ragged(np.zeros(len(held), np.int64), held)], np.uint64(0))
        made[run] = np.bitwise_or.reduceat(bits, np.cumsum(held) - held)
    return made


def _received(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys in ascending order and masks."""
    parts = [
        _unpack(data, n)
        for n, data in zip(answers.column("n").to_pylist(), answers.column("data").to_pylist(), strict=True)
    ]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    short, whole, mask = (np.concatenate(c) for c in zip(*parts, strict=True))
    keys = _keys(short, whole)
    order = np.argsort(keys)
    return keys[order], mask.astype(np.uint64)[order]


def _removed(held: _Block, answers: pa.Table) -> Iterator[tuple[pa.RecordBatch, Texts, np.ndarray]]:
    """The rows, their texts, and which bytes go."""
    keys, masks = _received(answers)
    mask = np.zeros(len(held.pairs), np.uint64)
    at = np.searchsorted(held.pairs, keys)
    mask[at] = masks
    done = 0
    for part, texts, start, count, docs, n in held.rows:
        place = held.place[done : done + n]
        done += n
        later = docs > held.smallest[place]
        bits = np.where(later, _ALL, mask[place])
        change = np.zeros(len(texts.data) + 1, np.int64)
        whole = bits == _ALL
        np.add.at(change, start[whole], 1)
        np.add.at(change, (start + count + LENGTH - 1)[whole], -1)
        for row in np.flatnonzero(~whole & (bits > 0)).tolist():
            strings = start[row] + np.flatnonzero((bits[row] >> _BIT[: count[row]]) & np.uint64(1))
            np.add.at(change, strings, 1)
            np.add.at(change, strings + LENGTH, -1)
        yield part, texts, np.cumsum(change)[:-1] > 0


def _dealt(docs: DataFrame, carried: list[str], count: int) -> DataFrame:
    """``block, id, text, row`` of each row, in ``count`` partitions by block."""
    number = F.col("doc_id").cast("long").alias("id")
    # A row's place in its partition: the same whenever the table is read again.
    place = F.xxhash64(F.monotonically_increasing_id(), F.lit(7))
    block = F.pmod(place, F.lit(count)).cast("int").alias("block")
    row = F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row")
    return docs.select(block, number, F.col("text").alias("text"), row).repartition(count, "block")


def cut_substrings(docs: DataFrame, carried: list[str], with_text: bool = False) -> DataFrame:
    """``carried`` (as a struct ``row``), ``n_bytes, n_removed, n_spans, kept_sha256`` per row, and
    with ``with_text`` what is left as ``kept_text`` (a character that lost bytes goes as a whole).

    The texts are dealt to blocks once; the three passes over them read the same shuffle.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(8, -(-size // BLOCK_BYTES))
    blocks = _dealt(docs, carried, count)

    def bucket_of(held: _Block, chosen: np.ndarray) -> np.ndarray:
        return (held.buckets[chosen] % np.uint64(count)).astype(np.int64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The partition's blocks: pairs are sent once for each.
        rows: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            tags = batch.column("block").to_numpy()
            for tag in np.unique(tags).tolist():
                chosen = batch.select(["id", "text"]).filter(pa.array(tags == tag))
                rows.setdefault(tag, []).append(chosen)
        for tag in list(rows):
            held = _Block(pa.Table.from_batches(rows.pop(tag)))
            every = np.arange(len(held.pairs))
            sent = _send(bucket_of(held, every), tag, held.short, held.whole, held.smallest)
            made = _rows(list(sent), _RECORD_NAMES, _RECORD_KINDS)
            del held, every, sent
            release()
            yield made
            del made
        release()

    first = (
        # All columns, so that every pass reads one and the same shuffle.
        blocks.mapInArrow(send, _RECORDS)
        .groupBy("bucket").applyInArrow(_first_round, _ANSWERS)
        .repartition(count, "block")
    )

    def send_bytes(rows: pa.Table, answers: pa.Table) -> pa.Table:
        names = [*_RECORD_NAMES, "sent", "bytes"]
        kinds = [*_RECORD_KINDS, pa.binary(), pa.binary()]
        keys, masks = _received(answers)
        asked = (masks & _SEVERAL) > 0
        if not asked.any():
            return pa.Table.from_batches([_rows([], names, kinds)])
        held = _Block(rows.select(["id", "text"]))
        place = np.searchsorted(held.pairs, keys[asked])
        sends = (masks[asked] & _SENDS) > 0
        data = {}
        # The bytes of each pair's first segment here.
        where = held.first[place]
        done = 0
        for _, texts, start, size, _, n in held.rows:
            mine = np.flatnonzero((where >= done) & (where < done + n) & sends)
            for k in mine.tolist():
                begin = start[where[k] - done]
                data[k] = texts.data[begin : begin + size[where[k] - done] + LENGTH - 1].tobytes()
            done += n
        bucket = bucket_of(held, place)
        made = []
        for tag in np.unique(bucket).tolist():
            chosen = np.flatnonzero(bucket == tag)
            [record] = _send(
                bucket[chosen], rows.column("block")[0].as_py(), held.short[place[chosen]],
                held.whole[place[chosen]], held.smallest[place[chosen]],
            )
            sent = [(i, data[k]) for i, k in enumerate(chosen.tolist()) if k in data]
            index = np.array([(i, len(d)) for i, d in sent], np.uint32).reshape(-1, 2)
            made.append([*record, index.tobytes(), b"".join(d for _, d in sent)])
        made = pa.Table.from_batches([_rows(made, names, kinds)])
        del held, data
        release()
        return made

    grouped = blocks.groupBy("block")
    second = (
        grouped.cogroup(first.groupBy("block")).applyInArrow(send_bytes, _RECORDS + ", sent binary, bytes binary")
        .groupBy("bucket").applyInArrow(_second_round, _ANSWERS)
        .repartition(count, "block")
    )
    made = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema = carrying(blocks, ["row"], made + (", kept_text string" if with_text else ""))

    def finish(rows: pa.Table, answers: pa.Table) -> pa.Table:
        made = []
        for part, texts, gone in _removed(_Block(rows), _decided(answers)):
            lost = np.concatenate([[0], np.cumsum(gone)])
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            heads = texts.offsets[:-1][texts.sizes > 0]
            opens[heads] = gone[heads]
            runs = np.concatenate([[0], np.cumsum(opens)])
            left = [
                texts.data[a:b][~gone[a:b]].tobytes()
                for a, b in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True)
            ]
            columns = [
                part.column("row"),
                pa.array(texts.sizes),
                pa.array(lost[texts.offsets[1:]] - lost[texts.offsets[:-1]]),
                pa.array(runs[texts.offsets[1:]] - runs[texts.offsets[:-1]]),
                pa.array([hashlib.sha256(b).hexdigest() for b in left]),
            ]
            names = ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                whole = part.column("text").is_null().to_pylist()
                columns.append(
                    pa.array([None if w else b.decode(errors="ignore") for w, b in zip(whole, left, strict=True)], pa.string())
                )
                names.append("kept_text")
            made.append(pa.RecordBatch.from_arrays(columns, names))
        release()
        if made:
            return pa.Table.from_batches(made)
        fields = [rows.schema.field("row"), *[pa.field(n, pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")]]
        fields += [pa.field(n, pa.string()) for n in ["kept_sha256", *["kept_text"] * with_text]]
        return pa.schema(fields).empty_table()

    return grouped.cogroup(first.unionByName(second).groupBy("block")).applyInArrow(finish, schema)


def _decided(answers: pa.Table) -> pa.Table:
    """Without the calls for bytes."""
    rows = []
    for block, n, data in zip(*(answers.column(c).to_pylist() for c in ("block", "n", "data")), strict=True):
        short, whole, mask = _unpack(data, n)
        final = (mask & _SEVERAL) == 0
        if final.any():
            rows.append([block, int(final.sum()), _pack(short[final], whole[final], mask[final])])
    batch = _rows(rows, ["block", "n", "data"], [pa.int32(), pa.int32(), pa.binary()])
    return pa.Table.from_batches([batch])


def substring_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row of ``docs``."""
    return cut_substrings(docs, ["doc_id"]).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
