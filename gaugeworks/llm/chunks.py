"""Questions that chunks of documents put to the whole corpus, as two Spark shuffles of compact rows.

Documents are gathered into chunks of a few megabytes, one row each. To find out which of its strings occur
elsewhere, a chunk sends their distinct sorted hashes, cut by hash range into one packet per bucket; a
bucket sees the packets of all chunks, and answers each entry with a few bits. A string that occurs in a third
of all documents is one entry per chunk. The answers are joined to the chunks, which work out the same
entries in the same order again, so no positions travel.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import LAST_ID, body, slim, stored

CHUNK_BYTES = 4 << 20

CHUNK = "chunk_id long, n_bytes long, n_words long, data binary, rest binary"
PACKET = "chunk_id long, bucket int, payload binary"
ANSWER = "chunk_id long, round int, bucket int, answer binary, hits long"


def freeze(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: significant byte planes, compressed."""
    parts = [np.array([len(arrays)], "<u4").tobytes()]
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize)
        used = int(np.flatnonzero(planes.any(0))[-1]) + 1 if planes.any() else 0
        parts.append(np.array([len(a), a.dtype.itemsize, used, ord(a.dtype.kind)], "<u4").tobytes())
        parts.append(planes[:, :used].T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def thaw(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 4
    for _ in range(int(np.frombuffer(raw, "<u4", 1)[0])):
        n, size, used, kind = (int(v) for v in np.frombuffer(raw, "<u4", 4, at))
        at += 16
        planes = np.zeros((n, size), np.uint8)
        planes[:, :used] = np.frombuffer(raw, np.uint8, n * used, at).reshape(used, n).T
        at += n * used
        out.append(planes.reshape(-1).view(f"{chr(kind)}{size}"))
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class Chunk:
    """Documents of a chunk: their ids (LAST_ID for a missing one), and the bytes of each."""

    def __init__(self, chunk_id: int, data: bytes, rest: bytes | None = None):
        self.chunk_id, self.rest = chunk_id, rest
        self.ids, ends, text = thaw(data)
        self.text = text.tobytes()
        self.ends = ends.astype(np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)

    def documents(self) -> Iterator[bytes]:
        for s, e in zip(self.starts, self.ends, strict=True):
            yield self.text[s:e]


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, whole_rows: bool = False) -> DataFrame:
    """Stored chunks of the documents. A document lies whole in one chunk; a larger one is a chunk by itself.

    With ``whole_rows`` a chunk carries all columns of its documents (as one Arrow message), so that a last
    pass can return them without a join.
    """
    own = slim(docs)
    if whole_rows:
        row = F.struct(*[f"`{c}`" for c in docs.columns])
        own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body(docs).alias("text"), row.alias("row"))

    def gather(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [t.as_py().encode("utf-8", "surrogatepass") for t in batch.column(1)]
            low, size = 0, 0
            for k in range(len(texts) + 1):
                full = k == len(texts) or (k > low and size + len(texts[k]) > chunk_bytes)
                if full and k > low:
                    part = texts[low:k]
                    ends = np.cumsum([len(t) for t in part], dtype=np.int64)
                    part_ids = np.array([LAST_ID if i is None else i for i in ids[low:k]], np.int64)
                    data = freeze(part_ids, ends, np.frombuffer(b"".join(part), np.uint8))
                    rest = packed_rows(batch.column(2).slice(low, k - low)) if whole_rows else None
                    yield _rows([(uuid.uuid4().int >> 65, size, sum(len(t.split()) for t in part), data, rest)], CHUNK)
                    low, size = k, 0
                if k < len(texts):
                    size += len(texts[k])

    return stored(own.mapInArrow(gather, CHUNK), "chunks")


def packed_rows(rows: pa.StructArray) -> bytes:
    """The columns of whole rows but for ``text``, of which only the missing ones are told."""
    fields = {f.name: rows.field(k) for k, f in enumerate(rows.type)}
    fields["text"] = fields["text"].is_null() if "text" in fields else None
    batch = pa.RecordBatch.from_arrays([v for v in fields.values()], names=list(fields))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked_rows(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def bucket_slices(sorted_hashes: np.ndarray, bits: int, buckets: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted hashes of so many bits per bucket; buckets are equal ranges."""
    top = sorted_hashes >> np.uint64(bits - 32) if bits > 32 else sorted_hashes << np.uint64(32 - bits)
    number = (top * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    edges = np.searchsorted(number, np.arange(buckets + 1))
    for b in np.unique(number):
        yield int(b), slice(int(edges[b]), int(edges[b + 1]))


def _chunks_of(batches) -> Iterator[tuple[Chunk, dict[tuple[int, int], bytes]]]:
    for batch in batches:
        names = batch.schema.names
        given = batch.column(names.index("answers")) if "answers" in names else None
        ids, data, rest = (batch.column(names.index(n)) for n in ("chunk_id", "data", "rest"))
        for k in range(batch.num_rows):
            answers = (given[k].as_py() or []) if given is not None else []
            yield Chunk(ids[k].as_py(), data[k].as_py(), rest[k].as_py()), {(a["round"], a["bucket"]): a["answer"] for a in answers}


def answered(chunks: DataFrame, *answers: DataFrame) -> DataFrame:
    """Chunks with the list of their answers."""
    every = answers[0]
    for more in answers[1:]:
        every = every.unionByName(more)
    lists = every.groupBy("chunk_id").agg(F.collect_list(F.struct("round", "bucket", "answer")).alias("answers"))
    return chunks.select("chunk_id", "data", "rest").join(lists, "chunk_id", "left")


def ask(
    chunks: DataFrame,
    round_: int,
    questions: Callable[[Chunk, dict], Iterator[tuple[int, bytes]]],
    resolve: Callable[[list[bytes]], list[tuple[bytes, int]]],
    name: str,
) -> DataFrame:
    """Stored answers of one round. ``questions`` makes (bucket, payload) of a chunk and its earlier answers;
    ``resolve`` sees all payloads of a bucket and gives (answer, number of hits) for each."""

    def send(batches):
        for chunk, earlier in _chunks_of(batches):
            rows = [(chunk.chunk_id, b, p) for b, p in questions(chunk, earlier)]
            yield _rows(rows, PACKET)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        found = resolve(pdf["payload"].tolist())
        return pd.DataFrame(
            {
                "chunk_id": pdf["chunk_id"].to_numpy(),
                "round": np.int32(round_),
                "bucket": pdf["bucket"].to_numpy(),
                "answer": [a for a, _ in found],
                "hits": [h for _, h in found],
            }
        )

    return stored(chunks.mapInArrow(send, PACKET).groupBy("bucket").applyInPandas(meet, ANSWER), name)


def finish(chunks: DataFrame, schema, work: Callable[[Chunk, dict], list[tuple] | pa.RecordBatch]) -> DataFrame:
    """What ``work`` makes of each answered chunk: rows, or a whole record batch."""

    def run(batches):
        for chunk, answers in _chunks_of(batches):
            made = work(chunk, answers)
            yield made if isinstance(made, pa.RecordBatch) else _rows(made, schema)

    return chunks.mapInArrow(run, schema)
