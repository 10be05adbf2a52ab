"""Operator 9, token-id files: directly addressable codes.

An id is split into ``BITS``-bit chunks. Level 0 holds every id's lowest chunk;
a continuation bitmap says which ids go on, and level k + 1 holds the next chunk of
just those, in order. The place of an id's next chunk is the number of set bits
before it, which a rank directory gives from one stored sum and at most
``RANK_EVERY`` bits. So any id is read by a few look-ups, and no block is decoded.

One shard (at most about ``SHARD_IDS`` ids, whole documents) is one binary value:
header, document directory, levels, bitmaps, rank directories. Shards are rows of a
Parquet table, the container every Spark store can write and read back, in ascending
doc_id order: (part, shard) is the order, ``first_doc`` and ``last_doc`` its bounds.

Scale: texts are range-partitioned by doc_id once; nothing else moves but one
number a shard. The order of repeated ids is by the text's hash.

Defined cases: null and empty texts have the end id alone; null doc_id sorts first;
repeated rows each have an entry; extra columns are ignored; an empty table gives
no shard and an empty result.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import token_ids
from .common import map_arrow, scratch_path, ship, slices

ship(__name__)

BITS = 8
RANK_EVERY = 512
SHARD_IDS = 1 << 20
MAGIC = b"DAC1"
_NULL = -(1 << 63)


class Codes:
    """Directly addressable codes over unsigned 32-bit ids."""

    def __init__(self, levels: list[np.ndarray], maps: list[np.ndarray], ranks: list[np.ndarray]):
        self.levels, self.maps, self.ranks = levels, maps, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> Codes:
        levels, maps, ranks, rest = [], [], [], ids.astype(np.uint32)
        while True:
            levels.append((rest & 255).astype(np.uint8))
            rest = rest >> BITS
            more = rest > 0
            maps.append(np.packbits(more, bitorder="little"))
            ranks.append(np.concatenate(([0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), RANK_EVERY), dtype=np.uint32))))[:-1]
                         .astype(np.uint32) if len(more) else np.zeros(0, np.uint32))
            rest = rest[more]
            if not len(rest):
                return cls(levels, maps, ranks)

    def __len__(self) -> int:
        return len(self.levels[0])

    def __getitem__(self, i: int) -> int:
        """One id, by rank look-ups."""
        value = 0
        for k, level in enumerate(self.levels):
            value |= int(level[i]) << BITS * k
            bits = self.maps[k]
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_EVERY
            part = bits[block * RANK_EVERY // 8:(i >> 3) + 1].copy()
            part[-1] &= (1 << (i & 7)) - 1
            i = int(self.ranks[k][block]) + int(np.unpackbits(part).sum())
        return value

    def decode(self) -> np.ndarray:
        value, at = np.zeros(len(self), np.uint32), np.arange(len(self))
        for k, level in enumerate(self.levels):
            value[at] |= level.astype(np.uint32) << np.uint32(BITS * k)
            at = at[np.unpackbits(self.maps[k], count=len(level), bitorder="little").astype(bool)]
        return value


def write_shard(docs: list[int | None], starts: np.ndarray, ids: np.ndarray) -> bytes:
    """``starts``: where each document's ids begin here, and the total."""
    codes = Codes.build(ids)
    out = [MAGIC, struct.pack("<IQI", len(docs), len(ids), len(codes.levels)),
           np.array([_NULL if d is None else d for d in docs], "<i8").tobytes(), np.asarray(starts, "<u8").tobytes()]
    for level, bits, rank in zip(codes.levels, codes.maps, codes.ranks):
        out += [struct.pack("<Q", len(level)), level.tobytes(), bits.tobytes(), rank.astype("<u4").tobytes()]
    return b"".join(out)


def read_shard(raw: bytes) -> tuple[list[int | None], np.ndarray, Codes]:
    if raw[:4] != MAGIC:
        raise ValueError("not a token shard")
    n_docs, _, n_levels = struct.unpack_from("<IQI", raw, 4)
    at = 4 + struct.calcsize("<IQI")

    def take(dtype: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, dtype, n, at)
        at += out.nbytes
        return out

    docs = [None if d == _NULL else d for d in take("<i8", n_docs).tolist()]
    starts = take("<u8", n_docs + 1)
    levels, maps, ranks = [], [], []
    for _ in range(n_levels):
        n = int(take("<u8", 1)[0])
        levels.append(take("u1", n))
        maps.append(take("u1", (n + 7) // 8))
        ranks.append(take("<u4", -(-n // RANK_EVERY)))
    return docs, starts, Codes(levels, maps, ranks)


_SHARDS = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()),
                     ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())])


def write_ids(docs: DataFrame, tokenizer_path: str, path: str, shard_ids: int = SHARD_IDS) -> None:
    """Encode every text and write the shards to the table ``path``."""
    shared = docs.sparkSession.sparkContext.broadcast(token_ids.describe(tokenizer_path))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")

    def run(batches):
        from pyspark import TaskContext

        part, shard = TaskContext.get().partitionId(), 0
        encoder = token_ids.encoder(shared)
        names: list = []
        raws: list[bytes] = []

        def flush():
            sizes = np.array([len(r) // encoder.dtype.itemsize for r in raws], np.int64)
            data = write_shard(names, np.concatenate(([0], np.cumsum(sizes))), np.frombuffer(b"".join(raws), encoder.dtype))
            row = [part, shard, names[0], names[-1], len(names), int(sizes.sum()), data]
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, _SHARDS)], schema=_SHARDS)

        held = 0
        for piece in slices(batches, 500):
            doc_ids, texts = (c.to_pylist() for c in piece.columns)
            for doc, raw in zip(doc_ids, encoder.encode(texts)):
                names.append(doc)
                raws.append(raw)
                held += len(raw) // encoder.dtype.itemsize
                if held >= shard_ids:
                    yield flush()
                    names, raws, held, shard = [], [], 0, shard + 1
        if names:
            yield flush()

    rows.mapInArrow(run, "part int, shard int, first_doc long, last_doc long, n_docs long, n_ids long, data binary"
                    ).write.mode("overwrite").parquet(path)


def shard_index(spark: SparkSession, path: str) -> DataFrame:
    """Shards with ``first_id``, the number of ids before them; a prefix sum over the
    writing tasks (one row each), then over each task's shards."""
    shards = spark.read.parquet(path).select("part", "shard", "n_ids")
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_first"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part").select(
        "part", "shard", "n_ids", (F.col("part_first") + F.col("inside")).alias("first_id"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    def start():
        def work(parts, shards, datas):
            out = {c: [] for c in ("part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32")}
            for part, shard, data in zip(parts, shards, datas):
                docs, starts, codes = read_shard(data)
                ids = codes.decode().astype("<u4")
                for doc, a, b in zip(docs, starts[:-1].tolist(), starts[1:].tolist()):
                    for c, v in zip(out, (part, shard, doc, a, b - a, zlib.crc32(ids[a:b].tobytes()))):
                        out[c].append(v)
            return out
        return work

    rows = map_arrow(spark.read.parquet(path).select("part", "shard", "data"),
                     "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long", start, rows=4)
    index = shard_index(spark, path).select("part", "shard", "first_id")
    return rows.join(index, ["part", "shard"]).select(
        "doc_id", (F.col("first_id") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(position, id) of the asked ``position``s in the whole run of ids, by random access.
    Positions are grouped by the shard they lie in; only those shards are read."""
    index = shard_index(spark, path)
    where = positions.select("position").join(
        index, (F.col("position") >= F.col("first_id")) & (F.col("position") < F.col("first_id") + F.col("n_ids")))
    asked = where.groupBy("part", "shard", "first_id").agg(F.collect_list("position").alias("positions"))

    def start():
        def work(firsts, positions, datas):
            out = {"position": [], "id": []}
            for first, asked, data in zip(firsts, positions, datas):
                codes = read_shard(data)[2]
                out["position"] += asked
                out["id"] += [codes[p - first] for p in asked]
            return out
        return work

    data = spark.read.parquet(path).select("part", "shard", "data")
    return map_arrow(asked.join(data, ["part", "shard"]).select("first_id", "positions", "data"),
                     "position long, id long", start, rows=4)


def encode_to_files(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write ``docs``' ids to a fresh place in the shared folder and read them back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token_files")
    write_ids(docs, tokenizer_path, path)
    return read_documents(spark, path)
