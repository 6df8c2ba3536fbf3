"""Token-id store of directly addressable codes (DACs).

An id is split into chunks of 8, 8 and 16 bits. Level 0 holds the low chunk of
every id; a bitmap tells which ids continue, and only those have a chunk on the
next level, at the position given by the rank of their bit. A rank directory
(ones before every block of 512 bits) makes that rank one lookup and one
popcount, so token ``i`` is read in at most three steps, whatever its place.

The store is a Parquet table of segments, written by Spark's own committer: a
lost executor's tasks run again and no half-written file is ever read. A segment
holds whole documents, in ascending id order, until it has ``SEGMENT_TOKENS``
ids or more. Shards follow the id order, so ``(shard, segment)`` does as well.

Defined cases: null text is the empty text (only the end id); a null id comes
first; rows with equal ids are all kept, ordered by a hash of their text; an
empty table gives an empty store; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from layertables.llm.common import shuffle_partitions, small_batches, text_or_empty, written
from layertables.llm.tokens import encoder

WIDTHS = (8, 8, 16)
RANK_BLOCK = 512
SEGMENT_TOKENS = 1 << 18
# As many found segments are sent to the readers of the codes as a list.
LISTED_SEGMENTS = 100_000
MAGIC = b"DAC1"
_DTYPE = {8: np.dtype("u1"), 16: np.dtype("<u2")}
STORE = "shard int, segment int, start bigint, n_tokens bigint, doc_ids array<bigint>, doc_tokens array<bigint>, codes binary"


def dac_encode(ids: np.ndarray) -> bytes:
    """Header, then per level: chunks, continuation bitmap, rank directory."""
    v = np.asarray(ids, dtype=np.uint32)
    out = [MAGIC, struct.pack("<I", len(v))]
    for k, w in enumerate(WIDTHS):
        chunks = (v & ((1 << w) - 1)).astype(_DTYPE[w])
        rest = v >> np.uint32(w) if k + 1 < len(WIDTHS) else np.zeros(len(v), np.uint32)
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more.astype(np.uint32), np.arange(0, len(v), RANK_BLOCK)) if len(v) else np.zeros(0, np.uint32)
        before = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4") if len(v) else ones.astype("<u4")
        out += [struct.pack("<I", len(v)), chunks.tobytes(), bits.tobytes(), before.tobytes()]
        v = rest[more]
    return b"".join(out)


class DacView:
    """Reads codes in place; nothing is decoded ahead."""

    def __init__(self, codes: bytes):
        if codes[:4] != MAGIC:
            raise ValueError("not a DAC segment")
        self.n = struct.unpack_from("<I", codes, 4)[0]
        at, self.levels = 8, []
        for w in WIDTHS:
            n = struct.unpack_from("<I", codes, at)[0]
            a = at + 4
            b = a + n * w // 8
            c = b + (n + 7) // 8
            at = c + 4 * -(-n // RANK_BLOCK)
            self.levels.append(
                (w, np.frombuffer(codes, _DTYPE[w], n, a), codes[b:c], np.frombuffer(codes, "<u4", (at - c) // 4, c))
            )

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for w, chunks, bits, before in self.levels:
            value |= int(chunks[i]) << shift
            shift += w
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BLOCK
            first = block * RANK_BLOCK // 8
            head = int.from_bytes(bits[first : (i >> 3) + 1], "little") & ((1 << (i - first * 8)) - 1)
            i = int(before[block]) + head.bit_count()
        return value

    def all(self) -> np.ndarray:
        """Every id of the segment, level by level."""
        out = np.zeros(self.n, np.uint32)
        at = np.arange(self.n)
        for k, (w, chunks, bits, _) in enumerate(self.levels):
            out[at] |= chunks.astype(np.uint32) << np.uint32(sum(WIDTHS[:k]))
            at = at[np.unpackbits(np.frombuffer(bits, np.uint8), count=len(at), bitorder="little").astype(bool)]
        return out


def _segments(path: str, end_id: int, segment_tokens: int):
    tail = np.array([end_id], "<u4").tobytes()
    schema = to_arrow_schema(StructType.fromDDL(STORE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, enc = TaskContext.get().partitionId(), encoder(path)
        segment = start = size = 0
        doc_ids: list = []
        parts: list[bytes] = []

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            row = [shard, segment, start, len(ids), doc_ids, [len(p) // 4 for p in parts], dac_encode(ids)]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)

        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist())):
                parts.append(ids + tail)
                doc_ids.append(doc_id)
                size += len(parts[-1]) // 4
                if size >= segment_tokens:
                    yield flush()
                    segment, start, size, doc_ids, parts = segment + 1, start + size, 0, [], []
        if parts:
            yield flush()

    return run


def write_token_store(
    df: DataFrame,
    path: str,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    segment_tokens: int = SEGMENT_TOKENS,
    shards: int | None = None,
) -> None:
    """Encode every whole text, append ``end_id`` to each, and write the store.

    The texts are shuffled once, by range of the id (rows of one id are split
    further by a hash of their text), and encoded where they land."""
    spark = df.sparkSession
    small_batches(spark)
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    docs = docs.repartitionByRange(shards or shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    rows = docs.mapInArrow(_segments(tokenizer_path, end_id, segment_tokens), STORE)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORE).parquet(path)


def shard_starts(store: DataFrame) -> DataFrame:
    """``(shard, base)``: ids before each shard. One row a shard."""
    sizes = store.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return sizes.select("shard", F.coalesce(before, F.lit(0)).alias("base"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            ids = DacView(row["codes"]).all().astype("<u4", copy=False)
            ends = np.cumsum(row["doc_tokens"])
            starts = ends - row["doc_tokens"]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([row["shard"]] * len(ends), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "local": pa.array(starts + row["start"], pa.int64()),
                    "n_tokens": pa.array(row["doc_tokens"], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[a:e].tobytes()) for a, e in zip(starts, ends)], pa.int64()),
                }
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the stored codes: ``doc_id, start, n_tokens, ids_crc32``."""
    store = read_store(spark, path)
    docs = store.select("shard", "start", "doc_ids", "doc_tokens", "codes").mapInArrow(
        _documents, "shard int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint"
    )
    # One row for each shard, which are as many as the writer's partitions.
    return docs.join(F.broadcast(shard_starts(store)), "shard").select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokens_at(spark: SparkSession, path: str, positions: DataFrame, col: str = "position") -> DataFrame:
    """``(position, token)`` for positions in the whole store, each once.

    A position finds its segment by an equi join on a grid of ``SEGMENT_TOKENS``
    cells, from the segments' sizes alone. Only the codes of segments that were found are
    then read: few enough of them (counted) go to the readers as a list, so that no
    codes are shuffled but theirs. A segment meets its own distinct positions, of which
    it has as many as ids at most. Positions outside the store give no row."""
    store = read_store(spark, path)
    cell = F.lit(SEGMENT_TOKENS)
    sizes = store.select("shard", "segment", "start", "n_tokens")
    segs = sizes.join(F.broadcast(shard_starts(sizes)), "shard").withColumn("first", F.col("base") + F.col("start"))
    segs = segs.withColumn("last", F.col("first") + F.col("n_tokens") - 1)
    cells = F.explode(F.sequence(F.floor(F.col("first") / cell), F.floor(F.col("last") / cell))).alias("cell")
    places = segs.select("shard", "segment", "first", "last", cells)
    wanted = positions.select(F.col(col).cast("bigint").alias("position")).distinct()
    wanted = wanted.withColumn("cell", F.floor(F.col("position") / cell))
    hit = wanted.join(places, "cell").filter("position between first and last").select("shard", "segment", "position", "first")
    hit = written(hit, "hits")
    found = hit.select("shard", "segment").distinct()
    codes = store.select("shard", "segment", "codes")
    if found.count() <= LISTED_SEGMENTS:
        shards = [r[0] for r in found.select("shard").distinct().collect()]
        codes = codes.filter(F.col("shard").isin(shards)).join(F.broadcast(found), ["shard", "segment"], "left_semi")
    else:
        codes = codes.join(found, ["shard", "segment"], "left_semi")

    def pick(left, right):
        import pandas as pd

        out = {"position": [], "token": []}
        for codes in left["codes"]:
            view = DacView(codes)
            for p, first in zip(right["position"], right["first"]):
                out["position"].append(p)
                out["token"].append(view[int(p - first)])
        return pd.DataFrame(out)

    key = ["shard", "segment"]
    return codes.groupBy(*key).cogroup(hit.groupBy(*key)).applyInPandas(pick, "position bigint, token bigint")
