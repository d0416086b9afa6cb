"""Cross-tokenizer alignment by inverted pair bitmaps.

Each text is encoded once by both vocabularies. Byte offsets where tokens of both end cut the tokens
into groups, and every two tokens of one group that are not of one vocabulary are linked. For each id
pair a shard of documents keeps one posting: a bitmap of the documents that hold the pair linked, and
bitmaps of the bits of how often each holds it beyond the first time (multiplicity planes). A bitmap is
stored as the list of its places where that is smaller.

Documents of two shards differ, so a pair's bitmaps are merged by adding up what they count: its
documents by the first bitmap, its links by all of them weighted by their bit. The counts go back along
the postings, shard by shard, and each shard adds up its documents' sums. What is shuffled are postings
(pairs of a shard), never links; a pair that every document holds is one row a shard.

Defined results: a text that is null or empty, or that either vocabulary does not give back byte for
byte, has no tokens: all numbers are zero and the digest is empty. Each row is a document of its own,
whatever its id. An empty table gives an empty result. A text of any length is encoded whole; a group of
many tokens is multiplied out by distinct ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import release
from trolley.llm.text import Texts, as_texts, eights, ragged, slices, span_names, sums_by
from trolley.llm.tokens import Vocabulary, vocabulary
from trolley.session import stored

#: Postings (pairs of a document) a shard closes after, and the documents it has at most.
SHARD_POSTINGS = 1_000_000
SHARD_DOCUMENTS = 1 << 16
#: Links of a group up to which they are listed one by one.
LISTED = 256
#: Distinct chunks a worker remembers before it starts afresh.
REMEMBERED = 500_000
#: Bits of an id of the second vocabulary in a pair's number.
PAIR_SHIFT = 24

BLANK = 32


def vocabulary_paths() -> tuple[str, str, str]:
    """The public byte-level vocabulary (a tokenizer file and equal ranks) and the piece model."""
    import public_tokenizers

    return tuple(
        public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")
    )


@dataclass
class ByteTable:
    """The bytes of every id, end to end."""

    data: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, entries: list[bytes]) -> ByteTable:
        size = np.array([len(e) for e in entries], np.int64)
        return cls(np.frombuffer(b"".join(entries), np.uint8), np.cumsum(size) - size, size)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.start[ids], self.size[ids])]


def byte_level_entries(words: Vocabulary) -> list[bytes]:
    """The bytes of a byte-level vocabulary's ids: printable characters of Latin-1 stand for
    themselves, the other bytes in order for the characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(plain))}
    entries = [b""] * words._slow.get_vocab_size()
    for token, i in words._slow.get_vocab().items():
        entries[i] = bytes(letters[c] for c in token) if set(token) <= letters.keys() else token.encode()
    return entries


class Pieces:
    """A piece model that puts a blank before each text, over texts that already begin with one.

    No piece has a blank after another character, so text is cut before each run of blanks: a chunk
    has the same ids wherever it stands. Equal chunks are encoded once per worker.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self._blank = self._model.piece_to_id("▁")
        self._cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.bytes = ByteTable.of(
            [bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        )
        self._forget()

    def _forget(self) -> None:
        self._names = np.zeros(0, np.uint64)
        self._starts = self._counts = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.int32)

    def _learn(self, raw: bytes, names: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        new = np.ones(len(names), bool)
        if len(self._names):
            at = np.minimum(np.searchsorted(self._names, names), len(self._names) - 1)
            new = self._names[at] != names
        if not new.any():
            return
        spans = zip((start + 1)[new].tolist(), (start + size)[new].tolist(), strict=True)
        ids = self._model.encode([raw[a:b].decode() for a, b in spans], num_threads=1)
        # To the model a chunk of one blank is an empty text.
        ids = [i or [self._blank] for i in ids]
        counts = np.array([len(i) for i in ids], np.int64)
        starts = len(self._ids) + np.cumsum(counts) - counts
        self._ids = np.concatenate([self._ids, *[np.array(i, np.int32) for i in ids]])
        at = np.searchsorted(self._names, names[new])
        self._names = np.insert(self._names, at, names[new])
        self._starts = np.insert(self._starts, at, starts)
        self._counts = np.insert(self._counts, at, counts)

    def ids(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids end to end, and how many each has; every text begins with a blank."""
        data = texts.data
        cut = np.zeros(len(data), bool)
        if self._cuts:
            cut[1:] = (data[1:] == BLANK) & (data[:-1] != BLANK)
        cut[texts.offsets[:-1]] = True
        start = np.flatnonzero(cut)
        size = np.diff(np.append(start, len(data)))
        names, first, where = np.unique(span_names(eights(data), start, size, 1), return_index=True, return_inverse=True)
        if len(self._names) > REMEMBERED:
            self._forget()
        self._learn(data.tobytes(), names, start[first], size[first])
        at = np.searchsorted(self._names, names)[where]
        counts = self._counts[at]
        per_text = np.bincount(texts.owner(start), counts, len(texts)).astype(np.int64)
        return self._ids[ragged(self._starts[at], counts)], per_text


def _decimals(highest: int) -> tuple[np.ndarray, np.ndarray]:
    """Each number's digits, and how many it has."""
    text = [str(i).encode() for i in range(highest)]
    wide = max(map(len, text))
    digits = np.frombuffer(b"".join(t.ljust(wide) for t in text), np.uint8).reshape(highest, wide)
    return digits, np.array([len(t) for t in text], np.int64)


@dataclass
class Groups:
    """Tokens of consecutive texts in their groups; ``doc`` is the text each group lies in."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    doc: np.ndarray

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, pair and number of its links, ascending by text and pair."""
        product = self.n_a * self.n_b
        first_a, first_b = np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b
        few = product[self.group_a] <= LISTED
        mine = self.group_a[few]
        width = self.n_b[mine]
        right = self.b[ragged(first_b[mine], width)].astype(np.int64)
        docs = [np.repeat(self.doc[mine], width)]
        pairs = [np.repeat(self.a[few].astype(np.int64) << PAIR_SHIFT, width) | right]
        times = [np.ones(len(right), np.int64)]
        for g in np.flatnonzero(product > LISTED).tolist():
            x, nx = np.unique(self.a[first_a[g] : first_a[g] + self.n_a[g]], return_counts=True)
            y, ny = np.unique(self.b[first_b[g] : first_b[g] + self.n_b[g]], return_counts=True)
            pairs.append(((x.astype(np.int64) << PAIR_SHIFT)[:, None] | y.astype(np.int64)).ravel())
            times.append(np.outer(nx, ny).ravel())
            docs.append(np.full(len(pairs[-1]), self.doc[g]))
        doc, pair, times = map(np.concatenate, (docs, pairs, times))
        order = np.lexsort((pair, doc))
        doc, pair, times = doc[order], pair[order], times[order]
        if not len(doc):
            return doc, pair, times
        heads = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])))
        return doc[heads], pair[heads], np.add.reduceat(times, heads)

    def spelled(self, digits: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3;`` of all texts end to end, and the bytes of each group in it."""
        table, width = digits
        both = self.n_a + self.n_b
        head = np.cumsum(both) - both
        ids = np.zeros(len(self.a) + len(self.b), np.int64)
        after = np.full(len(ids), ord(","), np.uint8)
        ids[head[self.group_a] + np.arange(len(self.a)) - (np.cumsum(self.n_a) - self.n_a)[self.group_a]] = self.a
        head_b = head + self.n_a
        ids[head_b[self.group_b] + np.arange(len(self.b)) - (np.cumsum(self.n_b) - self.n_b)[self.group_b]] = self.b
        after[head_b - 1] = ord("|")
        after[head + both - 1] = ord(";")
        wide = np.zeros((len(ids), table.shape[1] + 1), np.uint8)
        wide[:, :-1] = table[ids]
        sizes = width[ids]
        wide[np.arange(len(ids)), sizes] = after
        shown = np.arange(wide.shape[1]) <= sizes[:, None]
        return wide[shown], sums_by(both, sizes + 1)


class Aligner:
    """Both vocabularies in a worker."""

    def __init__(self, json_path: str, rank_path: str | None, model_path: str) -> None:
        self.first = vocabulary(json_path, rank_path)
        self.second = Pieces(model_path)
        self.first_bytes = ByteTable.of(byte_level_entries(self.first))
        self.digits = _decimals(max(len(self.first_bytes.size), len(self.second.bytes.size)))

    def groups(self, texts: Texts) -> tuple[Groups, np.ndarray, np.ndarray]:
        """Groups of the texts that both vocabularies give back, how many tokens each text has in
        either (none in the others); ``doc`` counts all texts."""
        full = np.flatnonzero(texts.sizes > 0)
        heads = texts.offsets[full]
        spaced = Texts(
            np.insert(texts.data, heads, BLANK),
            np.append(heads, len(texts.data)) + np.arange(len(full) + 1),
        )
        sides, good = [], np.ones(len(full), bool)
        for words, table in ((self.first, self.first_bytes), (self.second, self.second.bytes)):
            ids, counts = words.ids(spaced) if len(full) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            good &= sums_by(counts, table.size[ids]) == spaced.sizes
            sides.append((ids, counts, table))
        for ids, counts, table in sides:
            # Of texts with the right number of bytes: are they the right ones?
            data = spaced.data[ragged(spaced.offsets[:-1][good], spaced.sizes[good])]
            wrong = table.spelled(ids[np.repeat(good, counts)]) != data
            bad = np.flatnonzero(good)[np.searchsorted(np.cumsum(spaced.sizes[good]), np.flatnonzero(wrong), "right")]
            good[bad] = False
        (a, count_a, table_a), (b, count_b, table_b) = sides
        a, b = a[np.repeat(good, count_a)], b[np.repeat(good, count_b)]
        ends_a, ends_b = np.cumsum(table_a.size[a]), np.cumsum(table_b.size[b])
        common = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        owner = full[good][np.searchsorted(np.cumsum(spaced.sizes[good]), common)]
        found = Groups(
            a, b, group_a, group_b, np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common)), owner
        )
        numbers = []
        for counts in (count_a, count_b):
            per_text = np.zeros(len(texts), np.int64)
            per_text[full[good]] = counts[good]
            numbers.append(per_text)
        return found, *numbers


_LOADED: dict[tuple, Aligner] = {}


def _aligner(paths: tuple[str, str | None, str]) -> Aligner:
    if paths not in _LOADED:
        _LOADED[paths] = Aligner(*paths)
    return _LOADED[paths]


def _bitmaps(pair: np.ndarray, doc: np.ndarray, documents: int) -> Iterator[tuple[np.ndarray, bool, pa.Array]]:
    """Pairs and their bitmaps, from pairs and documents in order: places first, then whole bitmaps."""
    if not len(pair):
        return
    heads = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    counts = np.diff(np.append(heads, len(pair)))
    dense = 16 * counts > documents
    where = ragged(heads[~dense], counts[~dense])
    if len(where):
        offsets = np.append(0, 2 * np.cumsum(counts[~dense]))
        flat = doc[where].astype("<u2").tobytes()
        made = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(flat)]
        )
        yield pair[heads[~dense]], False, made.cast(pa.binary())
    rows = np.flatnonzero(dense)
    for k in range(0, len(rows), 256):
        part = rows[k : k + 256]
        bits = np.zeros((len(part), documents), bool)
        bits[np.repeat(np.arange(len(part)), counts[part]), doc[ragged(heads[part], counts[part])]] = True
        packed = np.packbits(bits, axis=1, bitorder="little")
        yield pair[heads[part]], True, pa.array([row.tobytes() for row in packed], pa.binary())


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


class Shard:
    """Documents whose postings are written together."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.documents = self.size = 0
        self._held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    @property
    def full(self) -> bool:
        return self.size >= SHARD_POSTINGS

    def add(self, documents: int, doc: np.ndarray, pair: np.ndarray, times: np.ndarray) -> None:
        self._held.append((doc + self.documents, pair, times))
        self.documents += documents
        self.size += len(doc)

    def postings(self) -> Iterator[tuple[int, np.ndarray, bool, pa.Array]]:
        """Plane, pairs, form and bitmaps."""
        if not self.size:
            return
        doc, pair, times = (np.concatenate(x) for x in zip(*self._held, strict=True))
        order = np.lexsort((doc, pair))
        doc, pair, more = doc[order], pair[order], times[order] - 1
        plane, chosen = 0, np.ones(len(doc), bool)
        while True:
            for pairs, dense, bits in _bitmaps(pair[chosen], doc[chosen], self.documents):
                yield plane, pairs, dense, bits
            if not (more >> plane).any():
                return
            chosen = (more >> plane & 1).astype(bool)
            plane += 1


#: Rows of postings that go to Spark at a time.
_ROWS = 20_000


def encoded(docs: DataFrame, paths: tuple[str, str | None, str]) -> DataFrame:
    """Rows of documents (``shard, place, doc_id, n_a, n_b, n_groups, n_links, groups_sha256``) and of
    postings (``shard, pair, plane, dense, bits``; without a place).

    Plane 0 has the documents that hold the pair, plane ``k`` those with bit ``k - 1`` set in how many
    links they hold beyond one. ``bits`` are places as little-endian 16-bit numbers, or the bitmap if
    ``dense``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"shard long, place int, doc_id {kind}, " + ", ".join(f"{c} long" for c in _NUMBERS)
    schema += ", groups_sha256 string, pair long, plane int, dense boolean, bits binary"
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(paths)
        types = dict.fromkeys(columns, pa.int64()) | dict(
            place=pa.int32(), groups_sha256=pa.string(), plane=pa.int32(), dense=pa.bool_(), bits=pa.binary()
        )

        def rows(n: int, given: dict[str, pa.Array | np.ndarray]) -> pa.RecordBatch:
            made = []
            for c in columns:
                value = given.get(c)
                if value is None:
                    value = pa.nulls(n, types[c])
                elif not isinstance(value, pa.Array):
                    value = pa.array(value, types[c])
                made.append(value)
            return pa.RecordBatch.from_arrays(made, columns)

        def closed(shard: Shard) -> Iterator[pa.RecordBatch]:
            for plane, pairs, dense, bits in shard.postings():
                for k in range(0, len(pairs), _ROWS):
                    part = pairs[k : k + _ROWS]
                    n = len(part)
                    given = {"shard": np.full(n, shard.number), "pair": part, "plane": np.full(n, plane)}
                    yield rows(n, given | {"dense": np.full(n, dense), "bits": bits.slice(k, n)})

        shard = Shard(TaskContext.get().partitionId() << 32)
        for batch in batches:
            types["doc_id"] = batch.column("doc_id").type
            for part in slices(batch, "text"):
                n = part.num_rows
                if shard.full or shard.documents + n > SHARD_DOCUMENTS:
                    yield from closed(shard)
                    shard = Shard(shard.number + 1)
                groups, n_a, n_b = aligner.groups(as_texts(part.column("text")))
                spelled, sizes = groups.spelled(aligner.digits)
                spans = np.bincount(groups.doc, sizes, n).astype(np.int64)
                ends = np.cumsum(spans)
                raw = spelled.tobytes()
                digests = [
                    hashlib.sha256(raw[b - s : b - 1]).hexdigest() if s else ""
                    for b, s in zip(ends.tolist(), spans.tolist(), strict=True)
                ]
                yield rows(
                    n,
                    {
                        "shard": np.full(n, shard.number),
                        "place": np.arange(shard.documents, shard.documents + n),
                        "doc_id": part.column("doc_id"),
                        "n_a": n_a,
                        "n_b": n_b,
                        "n_groups": np.bincount(groups.doc, minlength=n),
                        "n_links": np.bincount(groups.doc, groups.n_a * groups.n_b, n).astype(np.int64),
                        "groups_sha256": digests,
                    },
                )
                shard.add(n, *groups.links())
        yield from closed(shard)
        release()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pair_counts(postings: DataFrame) -> DataFrame:
    """``pair, n_docs, n_links`` of all documents, by popcounts of their bitmaps."""
    ones = F.expr("CASE WHEN dense THEN bitmap_count(bits) ELSE octet_length(bits) DIV 2 END")
    holds = F.when(F.col("plane") == 0, ones).otherwise(0)
    weight = F.expr("shiftleft(1L, greatest(plane - 1, 0))")
    return postings.groupBy("pair").agg(F.sum(holds).alias("n_docs"), F.sum(ones * weight).alias("n_links"))


def scored_pairs(postings: DataFrame) -> DataFrame:
    """``pair_counts`` with ``best``: no pair of the first id is held by more documents."""
    counts = pair_counts(postings).withColumn("a", F.shiftright("pair", PAIR_SHIFT))
    highest = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counts.join(highest, "a").selectExpr("pair", "n_docs", "n_links", "n_docs = most AS best")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up what postings return to their documents; the rows of a shard are consecutive."""
    now, n_best, count_sum = None, None, None

    def done() -> pa.RecordBatch:
        places = np.flatnonzero(count_sum)
        made = [np.full(len(places), now), places.astype(np.int32), n_best[places], count_sum[places]]
        return pa.RecordBatch.from_arrays(list(map(pa.array, made)), ["shard", "place", "n_best", "count_sum"])

    for batch in batches:
        shards = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if low == high:
                continue
            if shards[low] != now:
                if now is not None:
                    yield done()
                now = shards[low]
                n_best, count_sum = np.zeros((2, SHARD_DOCUMENTS), np.int64)
            part = batch.slice(low, high - low)
            weight = np.int64(1) << np.maximum(part.column("plane").to_numpy() - 1, 0).astype(np.int64)
            counts = part.column("n_docs").to_numpy()
            best = part.column("best").to_numpy(zero_copy_only=False)
            dense = part.column("dense").to_numpy(zero_copy_only=False)
            bits = part.column("bits")
            listed = as_texts(bits.filter(pa.array(~dense)))
            places = [listed.data.copy().view("<u2").astype(np.int64)]
            rows = [np.repeat(np.flatnonzero(~dense), listed.sizes // 2)]
            for k in np.flatnonzero(dense).tolist():
                held = np.flatnonzero(np.unpackbits(np.frombuffer(bits[k].as_py(), np.uint8), bitorder="little"))
                places.append(held)
                rows.append(np.full(len(held), k))
            place, row = np.concatenate(places), np.concatenate(rows)
            np.add.at(count_sum, place, (weight * counts)[row])
            np.add.at(n_best, place, (weight * best)[row])
    if now is not None:
        yield done()


def align(docs: DataFrame, paths: tuple[str, str | None, str] | None = None) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``."""
    rows = stored(encoded(docs, paths or vocabulary_paths()), "alignment")
    postings = rows.filter("pair IS NOT NULL").select("shard", "pair", "plane", "dense", "bits")
    scored = postings.join(scored_pairs(postings).drop("n_links"), "pair").drop("pair")
    met = scored.repartition("shard").sortWithinPartitions("shard")
    sums = met.mapInArrow(_sums, "shard long, place int, n_best long, count_sum long")
    documents = rows.filter("place IS NOT NULL").drop("pair", "plane", "dense", "bits")
    none = {c: F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")}
    return documents.join(sums, ["shard", "place"], "left").select(
        "doc_id", *_NUMBERS, none["n_best"], none["count_sum"], "groups_sha256"
    )
