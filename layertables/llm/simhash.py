"""SimHash near-duplicates with the pigeonring filter.

A fingerprint has 64 bits; bit ``b`` is 1 if it is set in over half of the hashes
of the document's word shingles. The bits are cut into five segments on a ring.
If two fingerprints differ in at most ``t`` bits, then from some segment on every
chain of ``l`` consecutive segments differs in at most ``l * t / 5`` bits. With
``t`` up to 4 the first segment of that chain is equal and the second differs in one
bit at most. So the candidates are an equi join on (segment, next segment):
every fingerprint is stored under its own key and looked up under that key and
those with one set bit of the second segment cleared (the differing bit is set on
one side, which meets the other). The longer chains are checked in the join, the
full distance last. Keys have 25 or 26 bits, so the work follows the number of
distinct fingerprints.

Equal fingerprints are one node from the start: exact copies never meet in a
join. Components come from :mod:`layertables.llm.components`.

Defined cases: null or empty text, or one without a word: fingerprint zero,
linked like any other; fewer words than a shingle: the whole sequence is the one
shingle; a null id is never the smallest of its group unless all are null;
repeated rows share a group; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layertables.llm.common import map_rows, small_batches, spread_join, text_or_empty, written
from layertables.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
WIDTHS = (13, 13, 13, 13, 12)
STARTS = (0, 13, 26, 39, 52)


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of a whole text. Words are runs of anything but
    ASCII white space, ``A-Z`` lower-cased."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = (np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)).tolist()
    starts = [0, *(e + 1 for e in ends)]
    ends.append(len(joined))
    k = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :])], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, *, text_col: str = "text", shingle_words: int = SHINGLE_WORDS, id_cols=("doc_id",)) -> DataFrame:
    """``id columns, fp`` with ``fp`` the fingerprint's bits as a signed long."""
    small_batches(df.sparkSession)

    def make():
        def run(b: pa.RecordBatch) -> dict:
            got = np.array([fingerprint(t, shingle_words) for t in b.column("_text").to_pylist()], np.uint64)
            return {"fp": pa.array(got.view(np.int64))}

        return run

    ids = [F.col(c).cast("bigint").alias(c) for c in id_cols]
    rows = df.select(*ids, text_or_empty(text_col).alias("_text"))
    return map_rows(rows, make, ", ".join(f"{c} bigint" for c in (*id_cols, "fp")))


def _keys(fps: np.ndarray, probe: bool) -> tuple[np.ndarray, np.ndarray]:
    """``(key, fingerprint)`` rows; a key also holds the number of its first segment."""
    keys, owners = [], []
    u = fps.view(np.uint64)
    seg = [(u >> np.uint64(s)) & np.uint64((1 << w) - 1) for s, w in zip(STARTS, WIDTHS)]
    for i in range(5):
        j = (i + 1) % 5
        head = (np.uint64(i) << np.uint64(32)) | (seg[i] << np.uint64(13))
        keys.append(head | seg[j])
        owners.append(fps)
        for b in range(WIDTHS[j] if probe else 0):
            bit = np.uint64(1 << b)
            has = (seg[j] & bit) > 0
            keys.append((head | seg[j] & ~bit)[has])
            owners.append(fps[has])
    return np.concatenate(keys).view(np.int64), np.concatenate(owners)


def _keyed(fps: DataFrame, name: str, probe: bool) -> DataFrame:
    def make():
        def run(b: pa.RecordBatch) -> dict:
            k, o = _keys(b.column("fp").to_numpy(zero_copy_only=False), probe)
            return {"k": pa.array(k), name: pa.array(o)}

        return run

    return map_rows(fps, make, f"k bigint, {name} bigint")


def _mask(first: int, length: int) -> int:
    m = 0
    for i in range(first, first + length):
        m |= ((1 << WIDTHS[i % 5]) - 1) << STARTS[i % 5]
    return m - (1 << 64) if m >> 63 else m


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(u, v)`` for distinct fingerprints in column ``fp`` that differ in at most
    ``max_bits`` bits; a pair may come more than once."""
    if not 0 <= max_bits < len(WIDTHS):
        raise ValueError("max_bits must be from 0 to 4")
    x = F.col("u").bitwiseXOR(F.col("v"))
    first = F.shiftright("k", 32).cast("int") + 1
    ok = (F.col("u") != F.col("v")) & (F.bit_count(x) <= max_bits)
    for length in (3, 4):
        masks = F.array(*[F.lit(_mask(i, length)) for i in range(5)])
        ok = ok & (F.bit_count(x.bitwiseAND(F.element_at(masks, first))) <= length * max_bits // 5)
    # A row of fps gives 5 rows here and up to 70 there, which Spark's estimate of size does not count: never broadcast.
    return _keyed(fps, "u", False).join(_keyed(fps, "v", True).hint("merge"), "k").filter(ok).select("u", "v")


def _grouped(df: DataFrame, *, text_col="text", shingle_words=SHINGLE_WORDS, max_bits=MAX_BITS, id_cols=("doc_id",)) -> tuple[DataFrame, DataFrame]:
    """``(id columns, fp)`` of every row and ``(fp, root)`` of every distinct fingerprint."""
    docs = written(fingerprints(df, text_col=text_col, shingle_words=shingle_words, id_cols=id_cols), "fingerprints")
    distinct = docs.select("fp").distinct()
    found = components(links(distinct, max_bits)).withColumnRenamed("node", "fp")
    # The merge hints here and below: a table of files under Spark's threshold is several times as large in a broadcast.
    roots = distinct.join(found.hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return docs, written(roots, "roots")


def group(df: DataFrame, **options) -> DataFrame:
    """``id columns, fp, root``: rows with one ``root`` belong together."""
    docs, roots = _grouped(df, **options)
    return spread_join(docs, roots, "fp")


def near_duplicates(df: DataFrame, **options) -> DataFrame:
    """``doc_id, fingerprint, component_id``."""
    docs, roots = _grouped(df, **options)
    # Rows are combined by fingerprint first, so that roots meet distinct fingerprints only.
    roots = written(roots.join(docs.groupBy("fp").agg(F.min("doc_id").alias("least")).hint("merge"), "fp"), "least")
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(spread_join(roots, least, "root").select("fp", "component_id"), "named")
    return spread_join(docs, named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, **options) -> DataFrame:
    """The rows of ``df``, all columns, with one document of every group: that
    with the smallest id (ties: the smallest hash of its text)."""
    t = options.get("text_col", "text")
    named = df.withColumn("_id", F.col("doc_id").cast("bigint")).withColumn("_h", F.xxhash64(t))
    docs, roots = _grouped(named.select("_id", "_h", t), id_cols=("_id", "_h"), **options)
    best = docs.groupBy("fp").agg(F.min(F.struct(F.col("_id").isNull().alias("_n"), "_id", "_h")).alias("best"))
    kept = best.join(roots.hint("merge"), "fp").groupBy("root").agg(F.min("best").alias("best")).select("best.*")
    # A null id as a number beside its mark, for a plain equi join.
    keys = ["_h", "_n", "_id"]
    plain = F.coalesce("_id", F.lit(0).cast("bigint"))
    named = named.withColumn("_n", F.col("_id").isNull()).withColumn("_id", plain)
    kept = kept.withColumn("_id", plain).select(*keys).distinct()
    # Of repeated rows (same id and text) every task hands on one at most; the join has the window's partitioning.
    row = F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))
    return named.withColumn("_row", row).filter("_row = 1").join(kept.hint("merge"), keys, "left_semi").select(*df.columns)
