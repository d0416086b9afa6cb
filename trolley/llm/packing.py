"""Concatenate and cut: token ids of all documents end to end, cut into fixed windows.

The first pass tokenises each document once, ends it with id 0 and stores its ids with the number
of ids before it in its partition. The partitions' totals (one number each) give every partition's
place in the whole, and the second pass cuts each document where a multiple of ``window`` falls.
Nothing is shuffled, and only the last window is not full.

Defined results: a null or empty text is its closing id alone. Repeated rows and rows without an id
are packed like any others. An empty table gives an empty result. A document of any length is cut
into as many pieces as windows it touches; only its own ids are held at once. Special tokens'
strings in a text are ordinary text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import release
from trolley.llm.text import as_texts, slices
from trolley.llm.tokens import vocabulary
from trolley.session import stored

WINDOW = 1024
CLOSING_ID = 0


def vocabulary_paths() -> tuple[str, str]:
    """The public byte-level vocabulary, as a tokenizer file and as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_ids(docs: DataFrame, paths: tuple[str, str | None]) -> DataFrame:
    """``doc_id, part, before, n, ids``: each document's ids, and how many precede it in its
    partition; ids are little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(*paths)
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in slices(batch, "text"):
                flat, counts = words.ids(as_texts(rows.column("text")))
                ends = np.cumsum(counts)
                closed = np.insert(flat, ends, CLOSING_ID).astype("<u4")
                sizes = counts + 1
                stops = np.cumsum(sizes)
                raw = closed.tobytes()
                spans = zip((4 * (stops - sizes)).tolist(), (4 * stops).tolist(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(np.full(len(sizes), part, np.int32)),
                        pa.array(before + stops - sizes),
                        pa.array(sizes),
                        pa.array([raw[a:b] for a, b in spans], pa.binary()),
                    ],
                    ["doc_id", "part", "before", "n", "ids"],
                )
                before += int(stops[-1])
        release()

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, part int, before long, n long, ids binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(
    docs: DataFrame, window: int = WINDOW, paths: tuple[str, str | None] | None = None, keep_ids: bool = False
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``,
    and the piece's ids with ``keep_ids``."""
    tokens = stored(token_ids(docs, paths or vocabulary_paths()), "ids")
    # One row per partition of the first pass.
    totals = {r[0]: r[1] for r in tokens.groupBy("part").agg(F.sum("n")).collect()}
    places = range(max(totals, default=-1) + 1)
    base = np.array([0, *accumulate(totals.get(p, 0) for p in places)], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "ids"):
                size = rows.column("n").to_numpy()
                place = base[rows.column("part").to_numpy()] + rows.column("before").to_numpy()
                first = place // window
                count = (place + size - 1) // window - first + 1
                row = np.repeat(np.arange(len(size)), count)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                sequence = first[row] + nth
                start = np.maximum(sequence * window - place[row], 0)
                stop = np.minimum((sequence + 1) * window - place[row], size[row])
                ids = [b.as_py() for b in rows.column("ids")]
                pieces = [
                    ids[r][4 * a : 4 * b]
                    for r, a, b in zip(row.tolist(), start.tolist(), stop.tolist(), strict=True)
                ]
                columns = {
                    "doc_id": rows.column("doc_id").take(pa.array(row)),
                    "start": start,
                    "length": stop - start,
                    "ids_crc32": np.array([zlib.crc32(p) for p in pieces], np.int64),
                    "doc_tokens": size[row],
                    "sequence_id": sequence,
                    "offset": place[row] + start - sequence * window,
                }
                if keep_ids:
                    columns["ids"] = pa.array(pieces, pa.binary())
                arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
                yield pa.RecordBatch.from_arrays(arrays, list(columns))
        release()

    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in numbers)
    return tokens.mapInArrow(run, schema + (", ids binary" if keep_ids else ""))
