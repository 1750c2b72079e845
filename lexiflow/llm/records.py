"""Token ids in files of length-delimited binary records, with offset indexes.

A record is framed as: length of the payload (uint64), masked checksum of those
8 bytes (uint32), payload, masked checksum of the payload (uint32); all little-
endian.  The checksum is CRC-32, rotated right by 15 bits plus a constant, so
that a checksum of bytes which hold checksums stays meaningful.  A payload is
the key (a flag byte: 1 if not null; int64), the width of an id in bytes (one
byte) and the ids.

A shard is a file of records and an index file: for each record its offset,
framed size, number of ids, and the ids before it in the shard (int64 each).
The manifest, a Parquet table that Spark commits, names the shards that count:
files of lost or repeated task attempts stay out of it.
"""

from __future__ import annotations

import functools
import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import load
from .common import by_bytes, small_batches
from .encode import as_binary

# Fixed value: the constant that is added to rotated checksums.
MASK = 0xA282EAD8
# Bytes after which a shard ends.
SHARD_BYTES = 32 << 20
HEAD, KEY = "<QI", "<BqB"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return size + struct.pack("<I", masked(size)) + payload + struct.pack("<I", masked(payload))


def unframe(data: bytes) -> bytes:
    """The payload of one framed record; an error if anything was changed."""
    size, check = struct.unpack_from(HEAD, data)
    begin = struct.calcsize(HEAD)
    payload = data[begin:begin + size]
    if (check != masked(data[:8]) or len(data) != begin + size + 4
            or struct.unpack_from("<I", data, begin + size)[0] != masked(payload)):
        raise ValueError("damaged record")
    return payload


@functools.cache
def _rust(path: str) -> tiktoken.Encoding:
    """The file's byte-level vocabulary in tiktoken's merger: the same ids as
    the tokenizers library's, several times as fast."""
    from .bpe import GPT2_SPLIT
    bpe = load(path)
    ranks = {t: i for i, t in enumerate(bpe.bytes_of) if bpe.token_of[i] not in bpe.special}
    return tiktoken.Encoding(os.path.basename(path), pat_str=GPT2_SPLIT, mergeable_ranks=ranks,
                             special_tokens=bpe.special)


def ids_of(text: str, path: str) -> np.ndarray:
    """Ids of a text; special tokens' strings in it are those tokens.  Texts on
    which the split patterns' Unicode versions may differ go to the library, and
    so do those whose runs of white space (of some 700,000 and more) are too long
    for the merger's split, which gives up on them with a ValueError."""
    bpe = load(path)
    if not bpe.rare(text):
        try:
            return _rust(path).encode_to_numpy(text, allowed_special="all").astype(np.uint32)
        except ValueError:
            pass
    return np.array(bpe.library.encode(text, add_special_tokens=False).ids, np.uint32)


def _open(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_records(docs: DataFrame, folder: str, path: str, end_id: int, key: str = "doc_id",
                  text: str = "text", shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every row's whole text, add ``end_id`` and write in order of ``key``.

    ``folder`` is a new one in a store that executors reach by pyarrow's file
    systems (file, hdfs, s3, gs).  A null text counts as empty: its record is
    the end id.  A null key comes first; equal keys are ordered by a hash of
    the text; repeated rows are records each.  An empty table gives a manifest
    without rows.  Further columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    rows = rows.withColumn("h", F.xxhash64("t")).repartitionByRange("k", "h").sortWithinPartitions("k", "h")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = np.dtype("<u2" if len(load(path).token_of) <= 1 << 16 and end_id < 1 << 16 else "<u4")
        fs, root = _open(folder)
        fs.create_dir(root, recursive=True)
        task, out, done = TaskContext.get().partitionId(), None, []
        shard = 0

        def close() -> None:
            nonlocal out, shard
            out.close()
            with fs.open_output_stream(f"{root}/{name}.idx") as side:
                side.write(np.array(index, "<i8").tobytes())
            done.append((task, shard, name, len(index), ids_before, at))
            out, shard = None, shard + 1

        for batch in batches:
            for part in by_bytes(batch, "t"):
                for k, t in zip(part.column("k").to_pylist(), part.column("t").to_pylist(), strict=True):
                    if out is None:
                        name = f"shard-{task:06d}-{shard:04d}-{uuid.uuid4().hex[:12]}"
                        out, index, at, ids_before = fs.open_output_stream(f"{root}/{name}.rec"), [], 0, 0
                    ids = np.append(ids_of(t or "", path), end_id).astype(wide)
                    record = frame(struct.pack(KEY, k is not None, k or 0, wide.itemsize) + ids.tobytes())
                    out.write(record)
                    index.append((at, len(record), len(ids), ids_before))
                    at, ids_before = at + len(record), ids_before + len(ids)
                    if at >= shard_bytes:
                        close()
        if out is not None:
            close()
        if done:
            columns = list(zip(*done, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()),
                 *[pa.array(c, pa.int64()) for c in columns[3:]]],
                names=["task", "part", "shard", "records", "tokens", "bytes"])

    rows.select("k", "t").mapInArrow(
        run, "task int, part int, shard string, records bigint, tokens bigint, bytes bigint"
    ).write.parquet(f"{folder}/manifest")


def read_records(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """``(key, start, n_tokens, ids)`` from the manifest's shards, read through
    their indexes with all checksums verified; ``start`` counts the ids of all
    records before; ids are little-endian uint32.  A damaged record fails the
    job.  The running total is over one row a shard.
    """
    shards = spark.read.parquet(f"{folder}/manifest")
    before = F.sum("tokens").over(Window.orderBy("task", "part")) - F.col("tokens")
    shards = shards.withColumn("before", before).select("shard", "before")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        for batch in batches:
            for shard, base in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                with fs.open_input_stream(f"{root}/{shard}.idx") as side:
                    index = np.frombuffer(side.read(), "<i8").reshape(-1, 4)
                with fs.open_input_file(f"{root}/{shard}.rec") as data:
                    first = 0
                    while first < len(index):           # runs of records of about 4 MB
                        last = first + 1
                        while last < len(index) and index[last, 0] + index[last, 1] - index[first, 0] <= 4 << 20:
                            last += 1
                        rows = index[first:last]
                        raw = data.read_at(int(rows[:, 1].sum()), int(rows[0, 0]))
                        keys, ids = [], []
                        for at, size, n, _ in (rows - [rows[0, 0], 0, 0, 0]).tolist():
                            payload = unframe(raw[at:at + size])
                            there, k, wide = struct.unpack_from(KEY, payload)
                            ids.append(np.frombuffer(payload, f"<u{wide}", offset=struct.calcsize(KEY)).astype("<u4"))
                            keys.append(k if there else None)
                            if len(ids[-1]) != n:
                                raise ValueError("index and record differ")
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys, pa.int64()), pa.array(rows[:, 3] + base), pa.array(rows[:, 2]),
                             as_binary(np.concatenate(ids), rows[:, 2])], names=[key, "start", "n_tokens", "ids"])
                        first = last

    # Shards of 32 MB: spread them singly over the tasks.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartition(width, "shard").mapInArrow(
        run, f"`{key}` bigint, start bigint, n_tokens bigint, ids binary")
