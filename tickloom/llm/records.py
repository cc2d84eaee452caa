"""Token ids as length-delimited binary records, with an index of offsets beside each file.

A file holds records one after the other, in ascending order of document id:

    length of the payload   8 bytes, little-endian unsigned
    masked checksum         4 bytes, of the 8 bytes before
    payload                 1 byte  1 if the document id is null, else 0
                            8 bytes document id, signed (0 where null)
                            1 byte  bytes per token id: 2 or 4
                            the token ids, little-endian unsigned
    masked checksum         4 bytes, of the payload

Checksums are CRC-32, turned right by 15 bits plus a constant, so that the checksum of data that
holds checksums is no special value. ``<file>.idx`` holds the offset of every record, 8 bytes each,
and the file's length at the end: a reader seeks any record without reading the others.

Which files count is in the manifest, a table written when all files are complete. A task that is
repeated writes new files; those of a lost attempt are in no manifest and no reader looks at them.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from tickloom.llm.common import col, file_system, shuffle_partitions, slices
from tickloom.llm.tokens import encoder

# Fixed values of the format.
LENGTH, CHECK, HEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<BqB")
MASK_TURN, MASK_PLUS = 15, 0xA282EAD8

MANIFEST = "shard int, path string, records long, tokens long, bytes long"
RECORDS = "shard int, record long, doc_id long, ids binary"
TOKEN_SLICE = 4 << 20
READ_BYTES = 4 << 20


def masked(data: bytes) -> int:
    """The masked CRC-32 of some bytes."""
    crc = zlib.crc32(data)
    return (((crc >> MASK_TURN) | (crc << (32 - MASK_TURN))) + MASK_PLUS) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, wide: bool) -> bytes:
    """One record: the payload between its length and its checksum."""
    kind = "<u4" if wide else "<u2"
    payload = HEAD.pack(doc_id is None, doc_id or 0, 4 if wide else 2) + ids.astype(kind).tobytes()
    length = LENGTH.pack(len(payload))
    return b"".join((length, CHECK.pack(masked(length)), payload, CHECK.pack(masked(payload))))


def parse(payload: bytes) -> tuple[int | None, bytes]:
    """The document id and the token ids, as little-endian unsigned 32-bit integers."""
    null, doc_id, width = HEAD.unpack_from(payload)
    ids = payload[HEAD.size :]
    if width == 2:
        ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
    return (None if null else doc_id), ids


def take_record(stream) -> bytes | None:
    """The payload of the next record, None at the end; raises ValueError where a checksum is wrong."""
    length = stream.read(LENGTH.size)
    if not length:
        return None
    check = stream.read(CHECK.size)
    if len(check) < CHECK.size or CHECK.unpack(check)[0] != masked(length):
        raise ValueError("the length of a record is damaged")
    size = LENGTH.unpack(length)[0]
    payload, check = stream.read(size), stream.read(CHECK.size)
    if len(payload) < size or len(check) < CHECK.size or CHECK.unpack(check)[0] != masked(payload):
        raise ValueError("a record is damaged")
    return payload


def write_records(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2,
    id_col: str = "doc_id", text_col: str = "text", shards: int | None = None,
) -> DataFrame:
    """Encode every text, write the files into ``folder`` and return the manifest, one row per file.

    Documents are dealt by ranges of (id, hash of the text) into ``shards`` files (by default the
    session's shuffle partitions), so a task holds one range, sorts it on disk if need be and streams
    it out. A null text counts as empty and gives the end id alone; a null id comes first; rows with
    equal ids stay, ordered by the hash of their text and the text; an empty table gives an empty manifest.
    Other columns of ``docs`` are not read. ``folder`` must be reachable from every task.
    """
    spark = docs.sparkSession
    rows = docs.select(col(docs, id_col).cast("long").alias("doc_id"), col(docs, text_col).alias("text"))
    order = ["doc_id", F.xxhash64("text"), "text"]
    dealt = rows.repartitionByRange(shards or shuffle_partitions(spark), *order[:2]).sortWithinPartitions(*order)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, shard = encoder(tokenizer), TaskContext.get().partitionId()
        wide, end = max(tool.size - 1, end_id) > 0xFFFF, np.array([end_id], np.uint32)
        where, root = file_system(folder)
        path = f"{root}/{shard:06d}-{uuid.uuid4().hex}.rec"
        out, offsets, tokens, at = None, [], 0, 0
        for batch in slices(batches, 1, TOKEN_SLICE):
            if out is None:
                where.create_dir(root, recursive=True)
                out = where.open_output_stream(path)
            counts, flat = tool.encode(batch.column(1))
            marks = np.concatenate([[0], np.cumsum(counts)])
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                record = frame(doc_id, np.append(flat[marks[k] : marks[k + 1]], end), wide)
                out.write(record)
                offsets.append(np.uint64(at))
                at += len(record)
            tokens += int(marks[-1]) + batch.num_rows
        if out is None:
            return
        out.close()
        with where.open_output_stream(f"{path}.idx") as index:
            index.write(np.array([*offsets, at], "<u8").tobytes())
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "path": f"{folder}/{path.rsplit('/', 1)[1]}", "records": len(offsets),
              "tokens": tokens, "bytes": at}],
            schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("records", pa.int64()),
                              ("tokens", pa.int64()), ("bytes", pa.int64())]),
        )

    return dealt.mapInArrow(write, MANIFEST)


_READ = pa.schema([("shard", pa.int32()), ("record", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())])


def _batches(found: Iterator[tuple[int, int, int | None, bytes]]) -> Iterator[pa.RecordBatch]:
    kept, size = [], 0
    for row in found:
        kept.append(row)
        size += len(row[3])
        if size >= READ_BYTES or len(kept) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*kept), _READ.types)], schema=_READ)
            kept, size = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*kept), _READ.types)], schema=_READ)


def read_records(manifest: DataFrame, tasks: int | None = None) -> DataFrame:
    """All records of the files of a (stored) manifest: shard, record (its place in the file), doc_id, ids.

    A task streams through a file; every length and checksum is verified, and a damaged file or one that
    holds another number of records than the manifest says raises an error. ``ids`` holds
    little-endian unsigned 32-bit integers.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, int | None, bytes]]:
            for batch in batches:
                for shard, path, records in zip(*(c.to_pylist() for c in batch.columns)):
                    where, at = file_system(path)
                    seen = 0
                    with where.open_input_stream(at, buffer_size=READ_BYTES) as stream:
                        while (payload := take_record(stream)) is not None:
                            yield shard, seen, *parse(payload)
                            seen += 1
                    if seen != records:
                        raise ValueError(f"{path} holds {seen} records instead of {records}")

        yield from _batches(rows())

    files = manifest.select("shard", "path", "records")
    return files.repartition(tasks or shuffle_partitions(manifest.sparkSession)).mapInArrow(read, RECORDS)


def read_shuffled(manifest: DataFrame, seed: int = 0, tasks: int | None = None) -> DataFrame:
    """The records dealt to tasks in an order shuffled by ``seed``, fetched through the offset indexes.

    Only offsets are shuffled: the index is read as rows (file, record, offset), dealt by ranges of a
    hash of file and record, and each task seeks its records. The order within a task is by that hash.
    """

    def offsets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path in zip(*(c.to_pylist() for c in batch.columns)):
                where, at = file_system(path)
                with where.open_input_file(f"{at}.idx") as index:
                    marks = np.frombuffer(index.read(), "<u8").astype(np.int64)
                for k in range(0, len(marks) - 1, 10_000):
                    some = marks[k : min(k + 10_000, len(marks) - 1)]
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array(np.full(len(some), shard, np.int32)), "path": [path] * len(some),
                        "record": np.arange(k, k + len(some)), "offset": some,
                    })

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, int | None, bytes]]:
            files: dict[str, pa.NativeFile] = {}
            for batch in batches:
                for shard, path, record, offset in zip(*(c.to_pylist() for c in batch.columns)):
                    if path not in files:
                        if len(files) >= 256:  # open files are few, whatever the number of shards
                            files.pop(next(iter(files))).close()
                        where, at = file_system(path)
                        files[path] = where.open_input_file(at)
                    files[path].seek(offset)
                    yield shard, record, *parse(take_record(files[path]))

        yield from _batches(rows())

    tasks = tasks or shuffle_partitions(manifest.sparkSession)
    files = manifest.select("shard", "path").repartition(tasks)
    index = files.mapInArrow(offsets, "shard int, path string, record long, offset long")
    key = F.xxhash64(F.lit(seed), "shard", "record")
    dealt = index.repartitionByRange(tasks, key).sortWithinPartitions(key)
    return dealt.mapInArrow(fetch, RECORDS)


def with_starts(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """The records with ``start``: the number of ids of all records before them.

    Ids are summed within a file by its records, and over the files by the manifest, which has one row
    per file; so no task sees more than one file's counts.
    """
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    bases = manifest.select("shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    n = (F.octet_length("ids") / 4).cast("long")
    own = W.partitionBy("shard").orderBy("record").rowsBetween(W.unboundedPreceding, -1)
    counted = records.withColumn("n_tokens", n).withColumn("_own", F.coalesce(F.sum("n_tokens").over(own), F.lit(0)))
    return counted.join(bases, "shard").withColumn("start", F.col("base") + F.col("_own")).drop("base", "_own")
