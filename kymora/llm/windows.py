"""Bounded-space online packing: documents stream past a fixed number of open windows in each partition.

A document's ids and end id are cut into full windows and a rest, which goes to the open window that it
leaves the least room in (best fit). Where none has room, a new window is opened; if as many as allowed are
open, the fullest is emitted first. Its room is padding when it is at most ``slack``; when it is more, the
rest is cut there, so that the window is full, and what is left of it is placed in turn. A task thus holds
``open_windows`` windows of ``capacity`` ids, whatever streams past.

The windows still open at a partition's end are leftovers and carry their ids. They are merged in rounds:
the leftovers of ``fan_in`` partitions, bounded by ``fan_in * open_windows * capacity`` ids, are packed
again, longest piece first, until one group is left. In that group windows are filled from the emptiest, and
the last one is cut at powers of two, which are not padded.

Each round is a written table, and rows of a partition come in the order of the written source, so a lost
executor's task gives the same windows again.

Defined cases: null texts count as empty, and an empty document has its end id alone; null doc_ids and
repeated rows are packed like any other row; other columns are ignored; an empty table gives no rows. A very
long text needs its ids, four bytes each, beside the encoder's pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymora.llm.chunks import encoder
from kymora.llm.common import batch_of, slices, stage, texts, tidy

COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
SCHEMA = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())])
OUT_ROWS = 50_000
ROUND, GROUP = 1 << 58, 1 << 30


@dataclass(slots=True)
class Piece:
    doc_id: int | None
    doc_tokens: int
    start: int
    ids: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc_id, self.doc_tokens, self.start, self.ids[:n]), Piece(self.doc_id, self.doc_tokens, self.start + n, self.ids[n:])


@dataclass(slots=True)
class Open:
    used: int = 0
    pieces: list[Piece] = field(default_factory=list)


class Packer:
    """Open windows of one partition; rows of emitted windows gather in ``rows`` until they are taken."""

    def __init__(self, capacity: int, open_windows: int, slack: int, first_sequence: int) -> None:
        self.capacity, self.most, self.slack, self.sequence = capacity, open_windows, slack, first_sequence
        self.windows: dict[int, Open] = {}
        self.room: list[tuple[int, int]] = []  # (room, window), ascending
        self.opened = 0
        self.rows: list[tuple] = []

    def emit(self, pieces: list[Piece], keep_ids: bool = False) -> None:
        offset = 0
        for p in pieces:
            raw = p.ids.tobytes()
            self.rows.append((p.doc_id, p.start, len(p), zlib.crc32(raw), p.doc_tokens, self.sequence, offset, raw if keep_ids else None))
            offset += len(p)
        self.sequence += 1

    def put(self, key: int, piece: Piece) -> None:
        window = self.windows[key]
        window.pieces.append(piece)
        window.used += len(piece)
        if window.used == self.capacity:
            self.emit(self.windows.pop(key).pieces)
        else:
            insort(self.room, (self.capacity - window.used, key))

    def place(self, piece: Piece) -> None:
        while len(piece) >= self.capacity:
            head, piece = piece.cut(self.capacity)
            self.emit([head])
        while len(piece):
            k = bisect_left(self.room, (len(piece), -1))
            if k < len(self.room):
                self.put(self.room.pop(k)[1], piece)
                return
            if len(self.windows) < self.most:
                self.windows[self.opened] = Open()
                self.opened += 1
                self.put(self.opened - 1, piece)
                return
            gap, key = self.room.pop(0)  # the fullest
            if gap <= self.slack:
                self.emit(self.windows.pop(key).pieces)
            else:
                head, piece = piece.cut(gap)
                self.put(key, head)

    def leave(self) -> None:
        """Emit what is open as leftovers, with their ids."""
        for _, key in self.room:
            self.emit(self.windows[key].pieces, keep_ids=True)
        self.windows, self.room = {}, []

    def close(self) -> None:
        """Fill the open windows from the emptiest, and cut the last at powers of two."""
        while len(self.room) > 1 and self.room[0][0] <= self.slack:
            self.emit(self.windows.pop(self.room.pop(0)[1]).pieces)
        while len(self.room) > 1:
            _, key = self.room.pop()
            self.most = len(self.room)
            for piece in sorted(self.windows.pop(key).pieces, key=len, reverse=True):
                self.most = max(len(self.windows), 1)
                self.place(piece)
        for _, key in self.room:
            window = self.windows.pop(key)
            if self.capacity - window.used <= self.slack:
                self.emit(window.pieces)
                continue
            rest, pieces, left = [], window.pieces[::-1], window.used
            while left:
                want = 1 << (left.bit_length() - 1)
                left -= want
                rest = []
                while want:
                    piece = pieces.pop()
                    if len(piece) > want:
                        piece, tail = piece.cut(want)
                        pieces.append(tail)
                    rest.append(piece)
                    want -= len(piece)
                self.emit(rest)
        self.room = []

    def take(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            rows, self.rows = self.rows, []
            yield batch_of(dict(zip(SCHEMA.names, zip(*rows))), SCHEMA)


def first_round(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, open_windows: int, slack: int) -> DataFrame:
    """Pieces of every document, packed within each partition; leftovers have ``ids``, and ``task`` is the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer(capacity, open_windows, slack, TaskContext.get().partitionId() * GROUP)
        for batch in slices(batches, "raw"):
            ids, bounds = encoder(tokenizer).encode(batch.column("raw"))
            ids = np.insert(ids, bounds[1:], np.uint32(end_id)).astype("<u4", copy=False)
            ends = (bounds + np.arange(len(bounds))).tolist()
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), ends, ends[1:]):
                packer.place(Piece(doc_id, b - a, 0, ids[a:b]))
            for window in packer.windows.values():  # what stays open no longer needs the slice
                for piece in window.pieces:
                    if piece.ids.base is not None:
                        piece.ids = piece.ids.copy()
            yield from packer.take(OUT_ROWS)
        packer.leave()
        yield from packer.take()

    return texts(docs).mapInArrow(tidy(run), f"{COLUMNS}, ids binary").withColumn("task", F.spark_partition_id())


def next_round(leftovers: DataFrame, nth: int, capacity: int, open_windows: int, slack: int, last: bool) -> DataFrame:
    """The leftovers of each group (column ``task``) packed again; ids stay with what is left over."""
    columns = f"{COLUMNS}, ids binary, task int"

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        task = key[0].as_py()
        packer = Packer(capacity, open_windows, slack, nth * ROUND + task * GROUP)
        got = table.select(SCHEMA.names).to_pylist()
        # longest first; the rest of the order only has to be the same each time
        got.sort(key=lambda r: (-r["length"], r["sequence_id"], r["offset"]))
        for r in got:
            packer.place(Piece(r["doc_id"], r["doc_tokens"], r["start"], np.frombuffer(r["ids"], "<u4")))
        packer.close() if last else packer.leave()
        batches = list(packer.take())
        out = pa.Table.from_batches(batches, SCHEMA)
        return out.append_column("task", pa.array(np.full(out.num_rows, task, np.int32)))

    return leftovers.groupBy("task").applyInArrow(pack, columns)


def pack_windows(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048, open_windows: int = 64, slack: int = 16, fan_in: int = 32) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece of every document."""
    if fan_in < 2 or open_windows < 1 or capacity < 1:
        raise ValueError("fan_in must be 2 or more, open_windows and capacity 1 or more")
    names = SCHEMA.names[:-1]
    now = stage(first_round(docs, tokenizer, end_id, capacity, open_windows, slack))
    out = now.filter("ids IS NULL").select(names)
    nth = 0
    while True:
        left = now.filter("ids IS NOT NULL")
        top = left.agg(F.max("task")).first()[0]
        if top is None:
            return out
        nth += 1
        now = stage(next_round(left.withColumn("task", (F.col("task") / fan_in).cast("int")), nth, capacity, open_windows, slack, last=top < fan_in))
        out = out.unionAll(now.filter("ids IS NULL").select(names))
