"""Length-delimited binary records of token ids, with a separate offset index.

A record: payload length (u64), masked CRC-32 of these eight bytes (u32), payload, masked CRC-32 of the payload (u32); little-endian.
Payload: flags (u8: 1 if doc_id is there, 2 if ids take four bytes), doc_id (i64), ids (u16 each where all fit, else u32). Index file: offset and size of each record (u64 pairs).
CRC-32 is zlib's; masked: rotated right by 15 bits plus 0xA282EAD8.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir
from .tokens import load

MANIFEST = "part long, path string, records long, ids long"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def unframe(data: bytes) -> bytes:
    """Payload of one record; ValueError if a checksum or a length is wrong."""
    if len(data) < 16 or struct.unpack_from("<I", data, 8)[0] != masked(data[:8]):
        raise ValueError("damaged record length")
    n = struct.unpack_from("<Q", data)[0]
    if len(data) != n + 16 or struct.unpack_from("<I", data, 12 + n)[0] != masked(data[12 : 12 + n]):
        raise ValueError("damaged record")
    return data[12 : 12 + n]


def write_records(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0, parts: int | None = None) -> DataFrame:
    """Write docs (doc_id, text) in ascending doc_id order; returns the manifest, a row per file (part, path, records, ids).

    Files are named by task attempt, so a lost or repeated task never mixes with another; the manifest names those that count.
    Null or empty text: the end id alone. Null doc_id comes first. Repeated rows each have a record. Empty table: no files.
    Other columns of docs are not read, whatever their names.
    """
    folder = folder or f"{shared_dir(docs.sparkSession)}/records-{uuid.uuid4().hex}"

    end = struct.pack("<I", end_id)

    def run(batches):
        encode, c, data, index = load(tokenizer), TaskContext.get(), None, None
        name = f"{folder}/part-{c.partitionId():06d}-{c.taskAttemptId()}"
        at = records = total = 0
        for b in batches:
            if data is None and b.num_rows:
                store, path = fs.FileSystem.from_uri(name)
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                data, index = store.open_output_stream(f"{path}.rec"), store.open_output_stream(f"{path}.idx")
            for doc, ids in zip(b.column(0).to_pylist(), encode(b.column(1).to_pylist())):
                raw = np.frombuffer(ids + end, "<u4")
                wide = int(raw.max()) > 0xFFFF
                rec = frame(struct.pack("<Bq", (doc is not None) + 2 * wide, doc or 0) + (raw if wide else raw.astype("<u2")).tobytes())
                data.write(rec)
                index.write(struct.pack("<QQ", at, len(rec)))
                at, records, total = at + len(rec), records + 1, total + len(raw)
        if data is not None:
            data.close()
            index.close()
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (c.partitionId(), name, records, total)], ["part", "path", "records", "ids"])

    d = docs.select(F.col("doc_id").cast("long"), "text")
    by = ["doc_id", F.xxhash64("text")]  # sampled for the ranges by the driver, so no text in it; the hash spreads rows of one doc_id
    d = d.repartitionByRange(parts, *by) if parts else d.repartitionByRange(*by)
    return d.sortWithinPartitions(*by, "text").mapInArrow(run, MANIFEST)


def read_record(path: str, number: int) -> tuple[int | None, np.ndarray]:
    """One record by its number, through the index: what a shuffled reader does."""
    store, p = fs.FileSystem.from_uri(path)
    with store.open_input_file(f"{p}.idx") as f:
        at, size = struct.unpack("<QQ", f.read_at(16, number * 16))
    with store.open_input_file(f"{p}.rec") as f:
        return _parse(unframe(f.read_at(size, at)))


def _parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc = struct.unpack_from("<Bq", payload)
    return (doc if flags & 1 else None), np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=9).astype("<u4")


def read_digests(spark, manifest: list) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every record, from the files. `manifest`: write_records' rows (one per file)."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not manifest:
        return spark.createDataFrame([], schema)
    files, start = [], 0
    for m in sorted(manifest, key=lambda m: m.part):
        files.append((m.path, start))
        start += m.ids

    def run(batches):
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                store, p = fs.FileSystem.from_uri(name)
                with store.open_input_file(f"{p}.idx") as f:
                    index = np.frombuffer(f.read(), "<u8").reshape(-1, 2)
                out = []
                with store.open_input_stream(f"{p}.rec") as f:
                    for _, size in index:
                        doc, ids = _parse(unframe(f.read(int(size))))
                        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return spark.createDataFrame(files, "path string, start long").repartition(len(files)).mapInArrow(run, schema)
