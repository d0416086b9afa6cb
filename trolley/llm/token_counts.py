"""Token counts of the sections of a text (or the fields of a record) from one encoding of it.

The text is encoded as a whole, so counts add up to what a model is fed. Every token has a span of
characters; spans are joined with the sections' spans. A token inside a section counts there. A
token across a boundary counts, whole, for the section that holds most of its characters, and for
the earliest of those that hold equally many.

Defined results: a null or empty text has one empty section without tokens. Characters split over
several tokens count as inside each of them. Null fields are empty. Repeated rows each give their
own result rows. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import per_slice
from trolley.llm.packing import vocabulary_paths
from trolley.llm.text import Texts, as_texts, ragged
from trolley.llm.tokens import vocabulary


def allocate(begin: np.ndarray, end: np.ndarray, section: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The section each token counts for, and whether it crosses a boundary.

    ``begin`` and ``end`` are the tokens' character spans; ``section`` holds the sections' first
    characters in ascending order, the first of them at or before every token.
    """
    first = np.searchsorted(section, begin, "right") - 1
    last = np.searchsorted(section, np.maximum(end - 1, begin), "right") - 1
    crossing = np.flatnonzero(last > first)
    if len(crossing):
        count = last[crossing] - first[crossing] + 1
        each = ragged(first[crossing], count)
        token = np.repeat(crossing, count)
        stops = np.append(section[1:], np.iinfo(np.int64).max)
        held = np.minimum(end[token], stops[each]) - np.maximum(begin[token], section[each])
        order = np.lexsort((each, -held, token))
        best = np.append(True, token[order][1:] != token[order][:-1])
        first[crossing] = each[order][best]
    crosses = np.zeros(len(begin), bool)
    crosses[crossing] = True
    return first, crosses


def _count(
    texts: Texts, starts: np.ndarray, paths: tuple[str, str | None]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per section that begins at the bytes ``starts``: its first character counted from the start
    of the data, its characters, its tokens, and those of them that cross a boundary."""
    words = vocabulary(*paths)
    flat, _ = words.ids(texts)
    stops = np.cumsum(words._bytes_of[flat])
    begins = stops - words._bytes_of[flat]
    # Characters begun up to a byte.
    upto = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
    section = upto[starts]
    # Empty sections share their first character with the next: they hold nothing.
    solid = np.append(starts[1:] > starts[:-1], starts[-1:] < len(texts.data))
    places = np.flatnonzero(solid)
    tokens = np.zeros(len(starts), np.int64)
    shared = np.zeros(len(starts), np.int64)
    if len(flat):
        chosen, crosses = allocate(upto[begins + 1] - 1, upto[stops], section[places])
        tokens[places] = np.bincount(chosen, minlength=len(places))
        shared[places] = np.bincount(chosen, crosses, minlength=len(places)).astype(np.int64)
    return section, np.diff(np.append(section, upto[-1])), tokens, shared


def section_token_counts(docs: DataFrame, paths: tuple[str, str | None] | None = None) -> DataFrame:
    """Per line of each text: ``doc_id, section, start, n_chars, n_tokens, n_shared``.

    Sections are lines with the line break that ends them; they cover the text. ``n_shared`` are
    the tokens counted here that reach into another section.
    """
    paths = paths or vocabulary_paths()

    def make(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = as_texts(rows.column("text"))
        breaks = np.flatnonzero(texts.data == 10) + 1
        owner = texts.owner(breaks - 1)
        # A break that ends its text begins no section.
        inner = breaks < texts.offsets[1:][owner]
        starts = np.concatenate([texts.offsets[:-1], breaks[inner]])
        row = np.concatenate([np.arange(len(texts)), owner[inner]])
        order = np.lexsort((starts, row))
        starts, row = starts[order], row[order]
        begin, chars, tokens, shared = _count(texts, starts, paths)
        head = np.searchsorted(row, np.arange(len(texts)))
        return pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id").take(pa.array(row)),
                *map(pa.array, (np.arange(len(row)) - head[row], begin - begin[head][row], chars, tokens, shared)),
            ],
            ["doc_id", "section", "start", "n_chars", "n_tokens", "n_shared"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, section long, start long, n_chars long, n_tokens long, n_shared long"
    return per_slice(docs.select("doc_id", "text"), make, schema)


def field_token_counts(
    records: DataFrame, key: str, fields: list[str], paths: tuple[str, str | None] | None = None
) -> DataFrame:
    """``key`` and ``n_tokens`` as an array, one number per field, of the fields' texts end to end."""
    paths = paths or vocabulary_paths()
    whole = F.concat(*[F.coalesce(records[f].cast("string"), F.lit("")) for f in fields])
    sizes = F.array(*[F.coalesce(F.octet_length(records[f].cast("string")), F.lit(0)) for f in fields])
    joined = records.select(records[key].alias("key"), whole.alias("text"), sizes.alias("sizes"))

    def make(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = as_texts(rows.column("text"))
        sizes = np.array(rows.column("sizes").to_pylist(), np.int64).reshape(len(texts), len(fields))
        starts = texts.offsets[:-1, None] + np.cumsum(sizes, 1) - sizes
        _, _, tokens, _ = _count(texts, starts.ravel(), paths)
        counts = tokens.reshape(-1, len(fields)).tolist()
        return pa.RecordBatch.from_arrays(
            [rows.column("key"), pa.array(counts, pa.list_(pa.int64()))], [key, "n_tokens"]
        )

    kind = records.schema[key].dataType.simpleString()
    return per_slice(joined, make, f"`{key}` {kind}, n_tokens array<long>")
