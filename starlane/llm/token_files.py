"""Token ids in binary shards: frequency-ranked, byte-aligned, with separate control bytes.

Ids are replaced by their rank in the corpus (the most frequent id is 0) and written in
one to four bytes each, low byte first. The lengths lie apart, four to a control byte, so
that a block is decoded without branches: a table of 256 rows gives the four lengths of a
control byte, their running sum the place of every value.

A shard holds the documents of one range of doc_id in ascending order, so the shards in
order of their number hold the whole corpus. It is a sequence of blocks of whole documents::

    b"SLTK"  version u32  n_docs u32  n_values u64  n_control u64  n_data u64
    has_id   u8[n_docs]        1, or 0 where doc_id is NULL
    doc_id   i64[n_docs]
    n_tokens u64[n_docs]
    control  u8[n_control]
    data     u8[n_data]

after a head b"SLRK", version u32, n_ranks u32, ids u32[n_ranks], the id of each rank.

Defined cases: NULL or empty text is the end id alone; NULL doc_id sorts first; equal
doc_ids are ordered by their ids; an empty table gives no shards and no rows; other columns
are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlane.llm.files import new_file, open_folder, table
from starlane.llm.tokens import encoder, portions
from starlane.sources.scratch import scratch_folder

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
DOCS_PER_SHARD = 8192
VALUES_PER_BLOCK = 1 << 20

HEAD, BLOCK, VERSION = b"SLRK", b"SLTK", 1
BLOCK_HEAD = struct.Struct("<4sIIQQQ")

#: Lengths of the four values of each control byte.
LENGTHS = np.array([[(c >> (2 * i) & 3) + 1 for i in range(4)] for c in range(256)], dtype=np.uint8)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, dtype="<u4")
    n = len(v)
    size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    code = np.zeros(-(-n // 4) * 4, dtype=np.uint8)
    code[:n] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    used = np.arange(4, dtype=np.uint8)[None, :] < size[:, None]
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_values(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The values of control bytes and data bytes, by table lookup."""
    size = LENGTHS[control].reshape(-1)[:n]
    ends = np.cumsum(size, dtype=np.int64)
    if (ends[-1] if n else 0) != len(data):
        raise ValueError("control bytes and data bytes disagree")
    starts = ends - size
    out = np.zeros(n, dtype="<u4")
    for k in range(4):
        has = size > k if k else slice(None)
        out[has] |= data[starts[has] + k].astype("<u4") << np.uint32(8 * k)
    return out


def write_block(stream, keys: list, parts: list[np.ndarray], rank: np.ndarray) -> None:
    values = rank[np.concatenate(parts)]
    control, data = encode_values(values)
    stream.write(BLOCK_HEAD.pack(BLOCK, VERSION, len(keys), len(values), len(control), len(data)))
    stream.write(np.array([k is not None for k in keys], dtype=np.uint8).tobytes())
    stream.write(np.array([k or 0 for k in keys], dtype="<i8").tobytes())
    stream.write(np.array([len(p) for p in parts], dtype="<u8").tobytes())
    stream.write(control)
    stream.write(data)


def write_shard(stream, keys: list, parts: list[np.ndarray], ids_by_rank: np.ndarray) -> None:
    stream.write(struct.pack("<4sII", HEAD, VERSION, len(ids_by_rank)) + ids_by_rank.astype("<u4").tobytes())
    rank = np.zeros(int(ids_by_rank.max(initial=0)) + 1, dtype="<u4")
    rank[ids_by_rank] = np.arange(len(ids_by_rank))
    at = 0
    while at < len(keys):
        end, values = at, 0
        while end < len(keys) and (end == at or values + len(parts[end]) <= VALUES_PER_BLOCK):
            values += len(parts[end])
            end += 1
        write_block(stream, keys[at:end], parts[at:end], rank)
        at = end


def read_shard(stream) -> Iterator[tuple[int | None, np.ndarray]]:
    """The documents of a shard in order, one block in memory at a time."""
    magic, version, n = struct.unpack("<4sII", stream.read(12))
    if magic != HEAD or version != VERSION:
        raise ValueError("not a token shard of this version")
    ids_by_rank = np.frombuffer(stream.read(4 * n), dtype="<u4")
    while head := stream.read(BLOCK_HEAD.size):
        magic, version, n_docs, n_values, n_control, n_data = BLOCK_HEAD.unpack(head)
        if magic != BLOCK or version != VERSION:
            raise ValueError("damaged token shard")
        has_id = np.frombuffer(stream.read(n_docs), dtype=np.uint8)
        keys = np.frombuffer(stream.read(8 * n_docs), dtype="<i8")
        counts = np.frombuffer(stream.read(8 * n_docs), dtype="<u8").astype(np.int64)
        control = np.frombuffer(stream.read(n_control), dtype=np.uint8)
        data = np.frombuffer(stream.read(n_data), dtype=np.uint8)
        ids = ids_by_rank[decode_values(control, data, n_values)]
        ends = np.cumsum(counts)
        for known, key, a, b in zip(has_id.tolist(), keys.tolist(), (ends - counts).tolist(), ends.tolist()):
            yield (key if known else None), ids[a:b]


def shard_bounds(docs: DataFrame, docs_per_shard: int) -> list[int]:
    """Upper doc_id of every shard but the last: one number per ``docs_per_shard`` rows."""
    n, low, high = docs.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    shards = max(1, -(-n // docs_per_shard))
    if shards == 1 or low is None:
        return []
    marks = [i / shards for i in range(1, shards)]
    found = docs.agg(F.percentile_approx("doc_id", marks, max(10_000, 10 * shards))).first()[0]
    return sorted(set(found))


def write_tokens(docs: DataFrame, vocabulary: str, folder: str, end_id: int = END_ID, docs_per_shard: int = DOCS_PER_SHARD) -> DataFrame:
    """Write the shards of all documents; the table of them (shard, name, n_docs, n_tokens).

    Texts are tokenized once: the rows dealt out by shard serve both the counting of ids
    and, once the ranks are known, the writing.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    bounds = np.array(shard_bounds(docs, docs_per_shard), dtype=np.int64)
    shards = len(bounds) + 1

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = encoder(vocabulary), np.uint32(end_id).tobytes()
        for batch in batches:
            for some in portions(batch):
                keys = some.column(0).to_pylist()
                ids = [x.tobytes() + end for x in tokens.encode(some.column(1).to_pylist())]
                shard = np.searchsorted(bounds, [k if k is not None else -(2**63) for k in keys], side="left")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), pa.array(keys, pa.int64()), pa.array(map(narrow, ids), pa.binary())],
                    ["shard", "doc_id", "ids"],
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = np.bincount(np.concatenate([widen(raw) for raw in batch.column(2).slice(at, 256).to_pylist()]))
                if len(part) > len(total):
                    part[: len(total)] += total
                    total = part
                else:
                    total[: len(part)] += part
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(total[ids], pa.int64())], ["id", "n"])

    def write(key, rows: pa.Table, ranks: pa.Table) -> pa.Table:
        keys, raw = rows.column("doc_id").to_pylist(), rows.column("ids").to_pylist()
        parts = [widen(r) for r in raw]
        order = sorted(range(len(keys)), key=lambda i: (keys[i] is not None, keys[i] or 0, raw[i]))
        names, n_tokens = [], sum(map(len, parts))
        if keys:
            ids_by_rank = np.asarray(ranks.column("ranks").combine_chunks().flatten()).astype("<u4")
            with new_file(folder, f"shard-{key[0].as_py():08d}") as (stream, name):
                write_shard(stream, [keys[i] for i in order], [parts[i] for i in order], ids_by_rank)
            names = [name]
        return pa.table({
            "shard": pa.array([key[0].as_py()] * len(names), pa.int32()), "name": pa.array(names, pa.string()),
            "n_docs": pa.array([len(keys)] * len(names), pa.int64()), "n_tokens": pa.array([n_tokens] * len(names), pa.int64()),
        })

    dealt = docs.mapInArrow(tokenize, "shard int, doc_id long, ids binary").repartition(shards, "shard")
    ranks = (
        dealt.mapInArrow(count, "id int, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("order"), "id")))["id"].alias("ranks"))
        .select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "ranks")
    )
    written = (
        dealt.groupBy("shard")
        .cogroup(ranks.groupBy("shard"))
        .applyInArrow(write, "shard int, name string, n_docs long, n_tokens long")
    )
    index = f"{folder}/index"
    written.write.parquet(index)
    return spark.read.schema(written.schema).parquet(index)


def narrow(raw: bytes) -> bytes:
    """Ids below 65536 in two bytes; a last byte tells the width."""
    ids = np.frombuffer(raw, dtype="<u4")
    return ids.astype("<u2").tobytes() + b"\2" if ids.max(initial=0) < 1 << 16 else raw + b"\4"


def widen(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw[:-1], dtype=f"<u{raw[-1]}")


def read_tokens(index: DataFrame, folder: str, checksums: bool = False) -> DataFrame:
    """Every document of the shards with its ids and the number of ids before it.

    With ``checksums`` the ids are turned into their number and the crc32 of their
    little-endian unsigned 32-bit form where they are read, rather than moved.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = index.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size = [], 0
                with system.open_input_stream(f"{path}/{name}") as stream:
                    for key, ids in read_shard(stream):
                        rows.append((key, start, ids))
                        start += len(ids)
                        size += len(ids)
                        if size > VALUES_PER_BLOCK:
                            yield rows_of(rows, checksums)
                            rows, size = [], 0
                if rows:
                    yield rows_of(rows, checksums)

    shards = max(1, index.count())
    found = "doc_id long, start long, " + ("n_tokens long, ids_crc32 long" if checksums else "ids array<int>")
    return starts.select("name", "start", "shard").repartition(shards, "shard").drop("shard").mapInArrow(read, found)


def rows_of(rows: list[tuple], checksums: bool) -> pa.RecordBatch:
    keys, starts, ids = zip(*rows)
    if checksums:
        columns = [keys, starts, map(len, ids), [zlib.crc32(np.ascontiguousarray(x, dtype="<u4")) for x in ids]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), lists], ["doc_id", "start", "ids"])


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "token_files")
    index = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), folder)
    return read_tokens(index, folder, checksums=True)
