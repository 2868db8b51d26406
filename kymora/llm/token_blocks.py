"""Token ids in files of patched frame-of-reference blocks.

A file holds whole documents in order. Its ids are cut into blocks of ``BLOCK`` values; a block stores its
minimum, the differences to it packed at the width that holds a chosen percentile of them, and a list of
the exceptions that need more bits. An index gives where each block starts, so a range of ids is read by
decoding the blocks that touch it.

    header    magic, version, ids, documents, blocks, exceptions (little-endian, like everything)
    documents doc_id i64[], null flag u8[], ids of the document u32[]
    index     minimum u32[], width u8[], first exception u64[], first payload word u64[]
    payload   u32[]; 32 differences of width w take w words
    patches   place in the block u16[], difference u32[]

Writing is a range sort by (doc_id, hash of the text) whose tasks each write files under names of their
own and return one row a file; only files that the committed rows name count, so a task that runs twice
after a lost executor leaves an unnamed file and nothing else.

Defined cases: null texts count as empty, and an empty document has its end id alone; null doc_ids come
first; rows with equal doc_id are ordered by the hash of their text; other columns are ignored; an empty
table gives no files and no rows. A text is held in one task with its ids, some 40 bytes a byte of text.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kymora.llm.chunks import encoder
from kymora.llm.common import batch_of, pick, shared_folder, slices, stage, texts, tidy

MAGIC, VERSION, BLOCK = b"KPFR", 1, 1024
HEADER = "<4sIQQQQ"
FILE_IDS = 2_000_000


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.searchsorted(np.uint64(1) << np.arange(33, dtype=np.uint64), x.astype(np.uint64), side="right").astype(np.uint8)


def pack(ids: np.ndarray, percentile: float = 0.95) -> dict[str, np.ndarray]:
    """Blocks of ``ids`` (u32): index, payload and patches."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    grid = np.zeros(blocks * BLOCK, np.uint32)
    grid[:n] = ids
    if n % BLOCK:
        grid[n:] = ids[(blocks - 1) * BLOCK :].min()
    grid = grid.reshape(blocks, BLOCK)
    least = grid.min(axis=1) if blocks else np.zeros(0, np.uint32)
    grid = grid - least[:, None]
    k = min(BLOCK - 1, int(percentile * BLOCK))
    width = _bits(np.partition(grid, k, axis=1)[:, k]) if blocks else np.zeros(0, np.uint8)
    over = (grid.astype(np.uint64) >> width[:, None].astype(np.uint64)) > 0
    row, place = np.nonzero(over)
    patch = grid[row, place]
    grid[over] = 0
    words = width.astype(np.int64) * (BLOCK // 32)
    start = np.cumsum(words) - words
    payload = np.zeros(int(words.sum()), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        of = np.flatnonzero(width == w)
        lanes = np.ascontiguousarray(grid[of].reshape(-1, 32).T)
        out = np.zeros((w, lanes.shape[1]), np.uint32)
        for j in range(32):
            word, shift = divmod(j * w, 32)
            out[word] |= lanes[j] << np.uint32(shift)
            if shift + w > 32:
                out[word + 1] |= lanes[j] >> np.uint32(32 - shift)
        payload[(start[of][:, None] + np.arange(w * (BLOCK // 32))).reshape(-1)] = out.T.reshape(-1)
    first = np.searchsorted(row, np.arange(blocks))
    return {"least": least, "width": width, "first": first.astype(np.uint64), "start": start.astype(np.uint64), "payload": payload, "place": place.astype(np.uint16), "patch": patch}


def unpack(index: dict[str, np.ndarray], blocks: np.ndarray) -> np.ndarray:
    """The ids of the given blocks, a row each."""
    width, start = index["width"][blocks], index["start"][blocks].astype(np.int64)
    grid = np.zeros((len(blocks), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        of = np.flatnonzero(width == w)
        words = index["payload"][(start[of][:, None] + np.arange(w * (BLOCK // 32))).reshape(-1)].reshape(-1, w).T
        words = np.ascontiguousarray(words)
        lanes = np.empty((32, words.shape[1]), np.uint32)
        mask = np.uint32((1 << w) - 1)
        for j in range(32):
            word, shift = divmod(j * w, 32)
            x = words[word] >> np.uint32(shift)
            if shift + w > 32:
                x = x | (words[word + 1] << np.uint32(32 - shift))
            lanes[j] = x & mask
        grid[of] = lanes.T.reshape(len(of), BLOCK)
    begin = index["first"].astype(np.int64)[blocks]
    end = np.append(index["first"], len(index["patch"])).astype(np.int64)[blocks + 1]
    each = end - begin
    at = np.repeat(begin - (np.cumsum(each) - each), each) + np.arange(each.sum())
    grid[np.repeat(np.arange(len(blocks)), each), index["place"][at]] = index["patch"][at]
    return grid + index["least"][blocks][:, None]


def to_bytes(doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ids: np.ndarray, percentile: float = 0.95) -> bytes:
    x = pack(np.asarray(ids, np.uint32), percentile)
    parts = [struct.pack(HEADER, MAGIC, VERSION, len(ids), len(lengths), len(x["least"]), len(x["patch"]))]
    parts += [np.asarray(doc_ids, "<i8").tobytes(), np.asarray(nulls, "u1").tobytes(), np.asarray(lengths, "<u4").tobytes()]
    parts += [x[k].astype(t).tobytes() for k, t in LAYOUT]
    return b"".join(parts)


LAYOUT = (("least", "<u4"), ("width", "u1"), ("first", "<u8"), ("start", "<u8"), ("payload", "<u4"), ("place", "<u2"), ("patch", "<u4"))


class TokenFile:
    """One file's documents; ids of any range, decoding only the blocks that it touches."""

    def __init__(self, blob: bytes) -> None:
        magic, version, self.n_ids, docs, blocks, patches = struct.unpack_from(HEADER, blob)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a file of token blocks")
        at = struct.calcsize(HEADER)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.nulls, self.lengths = take("<i8", docs), take("u1", docs), take("<u4", docs)
        self.index = {"least": take("<u4", blocks), "width": take("u1", blocks), "first": take("<u8", blocks), "start": take("<u8", blocks)}
        words = int(self.index["start"][-1]) + int(self.index["width"][-1]) * (BLOCK // 32) if blocks else 0
        self.index |= {"payload": take("<u4", words), "place": take("<u2", patches), "patch": take("<u4", patches)}

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = start // BLOCK, -(-stop // BLOCK)
        flat = unpack(self.index, np.arange(a, b)).reshape(-1)
        return flat[start - a * BLOCK : stop - a * BLOCK]


def _place(path: str):
    """The file system of a path or URI and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, file_ids: int = FILE_IDS, percentile: float = 0.95) -> DataFrame:
    """Write all documents in ascending doc_id order; one row a file: (file, part, nth, n_docs, n_ids, start).

    ``start`` is the number of ids in all files before; a file ends after the document that reaches ``file_ids``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = pa.schema([("file", pa.string()), ("part", pa.int32()), ("nth", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
        part, run_id, nth = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        store, root = _place(folder)
        store.create_dir(root, recursive=True)
        held: list[tuple] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal held, size, nth
            doc_ids, nulls, lengths, ids = (np.concatenate(x) for x in zip(*held))
            name = f"tokens-{part:06d}-{nth:05d}-{run_id}.kpf"
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(to_bytes(doc_ids, nulls, lengths, ids, percentile))
            row = batch_of({"file": [f"{folder}/{name}"], "part": [part], "nth": [nth], "n_docs": [len(lengths)], "n_ids": [len(ids)]}, schema)
            held, size, nth = [], 0, nth + 1
            return row

        for batch in slices(batches, "raw"):
            ids, bounds = encoder(tokenizer).encode(batch.column("raw"))
            n = np.diff(bounds)
            ids = np.insert(ids, bounds[1:], np.uint32(end_id))  # after each document's last id
            key = batch.column("doc_id")
            held.append((key.fill_null(0).to_numpy(), key.is_null().to_numpy(zero_copy_only=False).astype("u1"), n + 1, ids))
            size += len(ids)
            if size >= file_ids:
                yield close()
        if held:
            yield close()

    ordered = texts(docs, F.xxhash64("text").alias("tie")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    files = stage(ordered.select("doc_id", "raw").mapInArrow(tidy(run), "file string, part int, nth int, n_docs long, n_ids long"))
    # one row a file, so this window is as small as the list of files
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files that ``files`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for file, begin in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                store, path = _place(file)
                with store.open_input_stream(path) as f:
                    got = TokenFile(f.read())
                whole = memoryview(np.ascontiguousarray(got.ids(), "<u4")).cast("B")
                bounds = np.concatenate([[0], np.cumsum(got.lengths, dtype=np.int64)])
                crc = [zlib.crc32(whole[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield batch_of({"doc_id": pa.array(got.doc_ids, pa.int64(), mask=got.nulls.astype(bool)), "start": bounds[:-1] + begin, "n_tokens": got.lengths.astype(np.int64), "ids_crc32": crc}, schema)

    n = max(1, files.count())
    spread = pick(files, "file", "start").repartition(n, "file")
    return spread.mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_folder(spark: SparkSession) -> str:
    """A new folder for token files in the cluster's shared folder."""
    return f"{shared_folder(spark)}-tokens"
