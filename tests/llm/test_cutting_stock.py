"""Cutting-stock packing: exact round trips, no padding, and the linear program against bounds."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from layertables.llm import cutting_stock as C
from layertables.llm.tokens import PieceEncoder, public_path

PATH = public_path("word_bpe_49k.json")


def check(spark_df, max_tokens=C.MAX_TOKENS, end_id=2):
    """Every id lies in one piece, sequences are gapless and need no padding. Returns
    the numbers of documents, cut ones and sequences that are not full."""
    got = C.pack(spark_df, PATH, end_id=end_id, max_tokens=max_tokens).collect()
    enc = PieceEncoder(PATH)
    docs = Counter()
    ids = {}
    for r in spark_df.select("doc_id", "text").collect():
        b = enc.encode([r["text"] or ""])[0] + np.array([end_id], "<u4").tobytes()
        docs[(r["doc_id"], b)] += 1
        ids.setdefault((r["doc_id"], len(b) // 4), []).append(b)
    seen, sequences = Counter(), defaultdict(list)
    for r in got:
        assert 0 < r["length"] and r["start"] + r["length"] <= r["doc_tokens"]
        fits = [b for b in ids[(r["doc_id"], r["doc_tokens"])] if zlib.crc32(b[4 * r["start"] : 4 * (r["start"] + r["length"])]) == r["ids_crc32"]]
        assert fits
        seen[(r["doc_id"], r["doc_tokens"])] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    want = Counter()
    for (doc_id, b), n in docs.items():
        want[(doc_id, len(b) // 4)] += n * len(b) // 4
    assert seen == want
    short = 0
    for parts in sequences.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end == max_tokens or (end < max_tokens and end & (end - 1) == 0)
        short += end < max_tokens
    return sum(docs.values()), sum(r["length"] < r["doc_tokens"] and r["start"] == 0 for r in got), short


@given(st.lists(st.tuples(st.integers(1, 64), st.integers(1, 40)), max_size=30, unique_by=lambda p: p[0]), st.integers(1, 12))
@settings(max_examples=60, deadline=None)
def test_plans_use_every_document_once(pairs, most):
    counts = np.zeros(65, np.int64)
    for n, c in pairs:
        counts[n] = c
    lengths, class_of = C.length_classes(counts, most)
    assert len(lengths) <= most and all(lengths[class_of[n]] >= n for n, _ in pairs)
    by_class = np.bincount(class_of[class_of >= 0], counts[class_of >= 0], len(lengths)).astype(np.int64)
    solution = C.solve(lengths, by_class, 64)
    used = sum((a * v for a, _, v in solution), np.zeros(len(lengths)))
    assert np.allclose(used, by_class)
    plan = C.rounded(solution, lengths, by_class, 64)
    total = np.zeros(len(lengths), np.int64)
    for copies, size, r in plan:
        assert r > 0 and sum(int(lengths[k]) * n for k, n in copies.items()) <= size
        for k, n in copies.items():
            total[k] += n * r
    assert (total == by_class).all()
    tokens = int((counts * np.arange(65)).sum())
    assert sum(s * r for _, s, r in C.trimmed(plan, lengths, tokens)) <= tokens


def test_linear_program_is_near_its_bound():
    rng = np.random.default_rng(0)
    for drawn in (rng.integers(1, 4097, 50_000), np.clip(rng.lognormal(5.5, 1, 50_000).astype(int), 1, 4096)):
        counts = np.bincount(drawn, minlength=4097)
        lengths, class_of = C.length_classes(counts)
        by_class = np.bincount(class_of[class_of >= 0], counts[class_of >= 0], len(lengths)).astype(np.int64)
        cost = sum((s + C.SEQUENCE_COST) * v for _, s, v in C.solve(lengths, by_class, 4096))
        least = float((by_class * lengths).sum()) * (1 + C.SEQUENCE_COST / 4096)
        assert least <= cost * (1 + 1e-9) and cost < 1.01 * least


def test_column_generation_finds_patterns_that_pairs_cannot():
    # Only 7 + 4 + 3 + 2 fills 16 with these; equal numbers of each.
    lengths, counts = np.array([2, 3, 4, 7]), np.array([100, 100, 100, 100])
    solution = C.solve(lengths, counts, 16, [])
    assert sum(v for _, _, v in solution) == pytest.approx(100, rel=1e-3)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    n, cut, short = check(docs)
    assert short <= 12 + n // 100 and cut < n / 4


def test_no_long_documents_share_is_drawn(spark):
    # 2,000 documents of 25 to 34 ids in sequences of 64: two in each, with room left.
    rows = [(k, " ".join(["the"] * (24 + k % 10))) for k in range(2000)]
    n, cut, short = check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), max_tokens=64)
    assert short <= 6 and 0 < cut < n / 3


def test_one_document_many_times(spark):
    rows = [(7, "one and the same text") for _ in range(3000)] + [(8, "x")]
    n, cut, short = check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), max_tokens=64)
    assert n == 3001 and short <= 6


def test_defined_cases(spark, odd_docs, no_docs):
    check(odd_docs)
    assert C.pack(no_docs, PATH).collect() == []
    clash = spark.createDataFrame([(1, "a b c", 5, 6, "x"), (2, None, 7, 8, None)], "doc_id bigint, text string, uid bigint, length bigint, share string")
    assert check(clash)[0] == 2
