"""One user's marks of stored events, as the state store holds them.

Marks lie in slices of an hour of arrivals: one value a slice, so that a user's marks are read and
written, and expire, in a few values. A slice of more than ``WHOLE`` marks is spread over ``PARTS``
values by the id's checksum, of which only those are read that new ids fall into. So what a task holds
of a user is bounded by ``WHOLE`` marks an hour and the parts its events touch.
"""

from __future__ import annotations

from hashlib import blake2b
import zlib

SLICE_US = 3_600_000_000
WHOLE = 10_000
PARTS = 1024
#: The part of a slice that is not spread.
ALL = -1

INDEX_SCHEMA = "slices array<bigint>, spread array<boolean>"
KEY_SCHEMA = "slice bigint, part int"
PART_SCHEMA = "dedup_keys array<string>, processed_us array<bigint>"


BLOOM_KEY_SCHEMA = "slice bigint"
BLOOM_SCHEMA = "bits binary"
#: Bits a mark sets in its slice's filter.
BLOOM_HASHES = 4


def part_of(key: str) -> int:
    return zlib.crc32(key.encode()) % PARTS


class Marks:
    """``index`` (value state) says which slices there are and which are spread; ``parts`` (map state)
    holds them. Nothing is read before it is needed."""

    def __init__(self, index, parts) -> None:
        self._index_state, self._parts_state = index, parts
        self._held: dict[tuple[int, int], dict[str, int]] = {}
        self._changed: set[tuple[int, int]] = set()
        self._slices: dict[int, bool] | None = None
        self._known: dict[int, bool] = {}

    @property
    def slices(self) -> dict[int, bool]:
        if self._slices is None:
            found = self._index_state.get() if self._index_state.exists() else None
            self._slices = dict(zip(*found, strict=True)) if found else {}
            self._known = dict(self._slices)
        return self._slices

    def _part(self, place: tuple[int, int]) -> dict[str, int]:
        if place not in self._held:
            # A slice that is new to this batch has nothing stored.
            found = self._parts_state.getValue(place) if place[0] in self._known else None
            self._held[place] = dict(zip(*found, strict=True)) if found else {}
        return self._held[place]

    def _place(self, slice_: int, key: str) -> tuple[int, int]:
        return slice_, part_of(key) if self.slices.get(slice_) else ALL

    def get(self, key: str) -> int | None:
        """When the id was stored, if it is marked."""
        for slice_ in self.slices:
            marked = self._part(self._place(slice_, key)).get(key)
            if marked is not None:
                return marked
        return None

    def put(self, key: str, arrived_us: int) -> None:
        slice_ = arrived_us // SLICE_US
        self.slices.setdefault(slice_, False)
        place = self._place(slice_, key)
        self._part(place)[key] = arrived_us
        self._changed.add(place)
        if place[1] == ALL and len(self._held[place]) > WHOLE:
            self._spread(slice_)

    def drop(self, key: str, marked_us: int) -> None:
        place = self._place(marked_us // SLICE_US, key)
        del self._part(place)[key]
        self._changed.add(place)

    def add_part(self, slice_: int, part: int, keys: list[str], times: list[int]) -> None:
        """A part as a batch left it; each comes once."""
        self.slices[slice_] = part != ALL
        self._held[slice_, part] = dict(zip(keys, times, strict=True))
        self._changed.add((slice_, part))

    def _spread(self, slice_: int) -> None:
        whole = self._held[slice_, ALL]
        self.slices[slice_] = True
        for part in range(PARTS):
            self._held[slice_, part] = {}
        for key, marked in whole.items():
            place = slice_, part_of(key)
            self._held[place][key] = marked
            self._changed.add(place)
        self._held[slice_, ALL] = {}

    def sweep(self, upto_us: int) -> None:
        """Drop the slices that end by ``upto_us``."""
        for slice_ in [s for s in self.slices if (s + 1) * SLICE_US <= upto_us]:
            for part in range(PARTS) if self.slices.pop(slice_) else [ALL]:
                self._held[slice_, part] = {}
                self._changed.add((slice_, part))

    @property
    def oldest(self) -> int | None:
        return min(self.slices, default=None)

    @property
    def first(self) -> bool:
        """Nothing was marked before."""
        return bool(self.slices) and not self._known

    def save(self) -> list[int]:
        """Write what has changed; the slices that are new."""
        if not self._changed:
            return []
        for place in self._changed:
            held = self._held[place]
            if held:
                self._parts_state.updateValue(place, (list(held), list(held.values())))
            elif place[0] in self._known and self._parts_state.containsKey(place):
                self._parts_state.removeKey(place)
        new = [s for s in self.slices if s not in self._known]
        if self.slices != self._known:
            self._index_state.update((list(self.slices), list(self.slices.values())))
        return new


class BloomMarks:
    """The approximate alternative: a Bloom filter of ``bits`` bits a slice (map state ``filters``), which
    is of one size whatever a user stores.

    An id that is marked is always found. An id that is not may be, at the rate the filters are full, and a
    mark counts until its whole slice has expired, an hour longer at most.
    """

    def __init__(self, filters, bits: int) -> None:
        self._state, self._bits = filters, bits
        self._held: dict[int, bytearray] | None = None
        self._changed: set[int] = set()
        self._known: set[int] = set()

    @property
    def _filters(self) -> dict[int, bytearray]:
        if self._held is None:
            self._held = {key[0]: bytearray(value[0]) for key, value in self._state.iterator()}
            self._known = set(self._held)
        return self._held

    def _places(self, key: str) -> list[int]:
        digest = blake2b(key.encode(), digest_size=16).digest()
        first, step = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little") | 1
        return [(first + k * step) % self._bits for k in range(BLOOM_HASHES)]

    def get(self, key: str) -> int | None:
        """The latest moment the id can have been marked at."""
        places = self._places(key)
        found = [s for s, f in self._filters.items() if all(f[p >> 3] >> (p & 7) & 1 for p in places)]
        return (max(found) + 1) * SLICE_US - 1 if found else None

    def put(self, key: str, arrived_us: int) -> None:
        slice_ = arrived_us // SLICE_US
        held = self._filters.setdefault(slice_, bytearray(-(-self._bits // 8)))
        for p in self._places(key):
            held[p >> 3] |= 1 << (p & 7)
        self._changed.add(slice_)

    def drop(self, key: str, marked_us: int) -> None:
        """An expired mark goes with its slice."""

    def add_part(self, slice_: int, part: int, keys: list[str], times: list[int]) -> None:
        for key, marked in zip(keys, times, strict=True):
            self.put(key, marked)

    def sweep(self, upto_us: int) -> None:
        for slice_ in [s for s in self._filters if (s + 1) * SLICE_US <= upto_us]:
            del self._filters[slice_]
            self._changed.add(slice_)

    @property
    def oldest(self) -> int | None:
        return min(self._filters, default=None)

    @property
    def first(self) -> bool:
        return bool(self._filters) and not self._known

    def save(self) -> list[int]:
        for slice_ in self._changed:
            if slice_ in self._filters:
                self._state.updateValue((slice_,), (bytes(self._filters[slice_]),))
            elif slice_ in self._known:
                self._state.removeKey((slice_,))
        return [s for s in self._changed if s in self._filters and s not in self._known]
