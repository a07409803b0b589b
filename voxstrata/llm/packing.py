"""Packing token sequences by swap-based local search.

Documents are encoded where they lie. Only those longer than a sequence are cut: all their pieces but the first fill a
sequence each. The other pieces are dealt by a hash into groups of about ``group_pieces``; each group is packed alone,
so a group costs at most one sequence that is not nearly full, whatever the size of the corpus.

In a group, every piece is first a sequence of its own. Then, while there are more sequences than the tokens need, each
underfull one in turn gives tokens away: a piece moves, one piece is exchanged for a smaller one, or two for one, each
time with an underfull sequence and so that the least room is left there. Every step raises the sum of squared fills, so the search
ends; sequences that run empty disappear. Sequences without an exchange are tried again after others have changed, until
none is left that any underfull sequence takes part in.

Defined results: null text is empty and packs its end id alone; an empty table gives no rows; repeated rows are packed
once each; other columns are ignored; texts are encoded whole, whatever their length. Which pieces share a sequence
depends on the ids, the document's id and the piece's number only.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import combinations_with_replacement, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_type, id_and_text, stored, text_batches
from .subwords import subwords

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, spread long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, *, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece; ``spread`` is a hash of the document and piece. ``keep_ids`` adds the ids, 32 bits each."""
    schema = PIECES + ", ids binary" * keep_ids
    out = arrow_type(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = subwords(tokenizer)
        for batch in text_batches(batches):
            keys = batch.column(0).to_pylist()
            ids, ends = encoder.flat(batch.column(1))
            line = memoryview(np.insert(ids, ends, end_id).astype("<u4").tobytes())
            columns: list[list] = [[] for _ in out]
            at = 0
            for key, end in zip(keys, (ends + np.arange(1, len(ends) + 1)).tolist(), strict=True):
                n = end - at
                mark, first = zlib.crc32(line[4 * at : 4 * end]), n % capacity or capacity
                bounds = [0, *range(first, n + 1, capacity)]
                for k, (a, b) in enumerate(pairwise(bounds)):
                    raw = line[4 * (at + a) : 4 * (at + b)]
                    row = (key, k, a, b - a, zlib.crc32(raw), zlib.crc32(f"{key}:{k}".encode(), mark))
                    for column, value in zip(columns, (*row, bytes(raw)) if keep_ids else row, strict=True):
                        column.append(value)
                at = end
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


class _Underfull:
    """Bins with room. For each size of piece there, and for no piece (size 0), an entry: giving one up, the bin takes ``reach = room + size``.

    Entries stand in lists by (reach, room); big integers mark which reaches, and which rooms of a reach, have any. An entry
    whose bin has changed since is dropped when it is met.
    """

    def __init__(self, held: list[dict[int, list[int]]], fill: list[int], capacity: int):
        self.held, self.fill, self.capacity = held, fill, capacity
        self.version = [0] * len(held)
        self.reaches, self.rooms = 0, [0] * (2 * capacity + 1)
        self.entries: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for t in range(len(held)):
            self.enter(t)

    def enter(self, t: int) -> None:
        """After a change of bin ``t``."""
        self.version[t] += 1
        room = self.capacity - self.fill[t]
        if room and self.fill[t]:
            for size in (0, *self.held[t]):
                reach = room + size
                self.entries.setdefault((reach, room), []).append((t, self.version[t]))
                self.reaches |= 1 << reach
                self.rooms[reach] |= 1 << room

    def _other(self, entries: list[tuple[int, int]], source: int) -> int | None:
        """The bin of a valid entry that isn't the source's; a bin has one entry at most in a list."""
        own = None
        while entries:
            t, version = entries[-1]
            if version == self.version[t]:
                if t != source:
                    break
                own = entries[-1]
            entries.pop()
        found = entries[-1][0] if entries else None
        if own:
            entries.append(own)
        return found

    def find(self, size: int, source: int, most: int) -> tuple[int, int, int] | None:
        """For a gift of ``size``: (room left, -gain, bin) with the least room left, less than ``most``, then the most gain."""
        left, reach = self.reaches >> size, size - 1
        while left:
            step = (left & -left).bit_length()
            reach, left = reach + step, left >> step
            over = reach - size
            if over >= most:
                return None
            rooms = self.rooms[reach] >> (over + 1)  # what is given back is smaller than the gift
            while rooms:
                room = over + rooms.bit_length()
                entries = self.entries[reach, room]
                found = self._other(entries, source)
                if found is not None:
                    return over, over - room, found
                if not entries:
                    self.rooms[reach] &= ~(1 << room)
                    if not self.rooms[reach]:
                        self.reaches &= ~(1 << reach)
                rooms &= (1 << (room - over - 1)) - 1
        return None


def _gifts(own: dict[int, list[int]]) -> dict[int, tuple[int, ...]]:
    """Sizes of one piece or two of a bin, by their sum; one goes before two."""
    two = {a + b: (a, b) for a, b in combinations_with_replacement(own, 2) if a != b or len(own[a]) > 1}
    return two | {a: (a,) for a in own}


def exchange(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Local search from ``bins``; returns bins with no fewer squared fill, some of them perhaps empty.

    Every underfull bin is tried, the fullest first (so small pieces are left to fill the last gaps), until no exchange
    raises the sum of squares or no bin can be saved.
    """
    sizes = lengths.tolist()
    held: list[dict[int, list[int]]] = [{} for _ in range(int(bins.max(initial=-1)) + 1)]
    fill = [0] * len(held)
    for i, t in enumerate(bins.tolist()):
        held[t].setdefault(sizes[i], []).append(i)
        fill[t] += sizes[i]
    least, used = math.ceil(sum(sizes) / capacity), sum(1 for x in fill if x)
    places = _Underfull(held, fill, capacity)
    queue = [(-x, t) for t, x in enumerate(fill) if 0 < x < capacity]
    heapify(queue)
    stuck: set[int] = set()
    changed = False

    def move(size: int, a: int, b: int) -> None:
        held[b].setdefault(size, []).append(held[a][size].pop())
        if not held[a][size]:
            del held[a][size]

    while used > least:
        if not queue:
            if not changed:
                break
            # exchanges since then may have opened others
            queue, stuck, changed = [(-fill[t], t) for t in stuck if 0 < fill[t] < capacity], set(), False
            heapify(queue)
            continue
        now, source = heappop(queue)
        if -now != fill[source] or source in stuck:
            continue
        best, given = None, ()
        for total, gift in _gifts(held[source]).items():
            # the sum of squares grows if the other bin ends with less room than the source has
            found = places.find(total, source, capacity + now)
            if found and (best is None or found[:2] < best[:2]):
                best, given = found, gift
        if best is None:
            stuck.add(source)
            continue
        _, lost, to = best
        back = sum(given) + lost
        if back:
            move(back, to, source)
        for size in given:
            move(size, source, to)
        fill[source] += lost
        fill[to] -= lost
        changed = True
        for t in (source, to):
            places.enter(t)
            stuck.discard(t)
            if 0 < fill[t] < capacity:
                heappush(queue, (-fill[t], t))
        used -= not fill[source]
    out = np.empty(len(bins), np.int64)
    for t, x in enumerate(held):
        for own in x.values():
            out[own] = t
    return out


def _pack(table: pa.Table, capacity: int, base: int) -> pa.Table:
    table = table.sort_by([("spread", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
    lengths = table.column("length").to_numpy().astype(np.int64)
    bins = exchange(lengths, np.arange(len(lengths)), capacity)
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    new = np.flatnonzero(np.diff(bins[order], prepend=-1))
    before = np.repeat((ends - lengths[order])[new], np.diff(np.append(new, len(order))))
    table = table.take(pa.array(order)).drop_columns(["spread"])
    return table.append_column("sequence_id", pa.array(base + bins[order])).append_column("offset", pa.array(ends - lengths[order] - before))


def pack_pieces(cut: DataFrame, capacity: int, group_pieces: int = 100_000) -> DataFrame:
    """Give each piece its sequence and its place there. ``cut`` should be a stored table: it is read twice."""
    open_pieces = cut.filter(F.col("length") < capacity)
    groups = max(1, math.ceil(open_pieces.count() / group_pieces))
    more = ", ids binary" * ("ids" in cut.columns)
    order = [x.split()[0] for x in (PLACED + more).split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # a group is bounded by group_pieces rows of fixed width (and, with ids, capacity ids each)
        held = [b for b in batches if b.num_rows]
        if held:
            done = _pack(pa.Table.from_batches(held), capacity, (2 * TaskContext.get().partitionId() + 1) << 32)
            yield from done.select(order).to_batches(max_chunksize=10_000)

    packed = open_pieces.repartition(groups, F.xxhash64("spread", "doc_id", "piece")).mapInArrow(pack, PLACED + more)
    # a full piece is a sequence of its own: numbered in its task, with even high parts
    full = cut.filter(F.col("length") >= capacity).withColumn("sequence_id", F.monotonically_increasing_id())
    high, low = F.shiftright("sequence_id", 33), F.col("sequence_id").bitwiseAND((1 << 33) - 1)
    full = full.withColumn("sequence_id", -1 - (F.shiftleft(high, 33) + low)).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(full.select(*order))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, *, group_pieces: int = 100_000, keep_ids: bool = False, **columns) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` ids; the pieces go through a stored table."""
    return pack_pieces(stored(pieces(docs, tokenizer, capacity, end_id, keep_ids=keep_ids, **columns), "pieces"), capacity, group_pieces)
