"""The registered queries: contract columns and types, and the pipeline against a
plain run of its stages."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
import corpus_pipeline
from layertables.llm import decontam, secrets, simhash, toxicity
from layertables.llm.tokens import PieceEncoder, public_path

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_token_store": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op2_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_surrogates": "doc_id bigint, text string",
    "op4_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op5_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op6_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op7_neighbours": "query_id bigint, rank int, vec_id bigint, score double",
    "op8_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op9_chats": "conv_id bigint, text string",
    "op10_decontaminate": "doc_id bigint, item_id bigint",
    "op11_cutting_stock": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op12_prefix_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    "op13_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
}


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in e.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(names) == sorted([*COLUMNS, "pipeline"])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    df = e.queries()[name](spark, SF)
    types = dict(df.dtypes)
    for c in COLUMNS[name].split(", "):
        column, kind = c.split(" ")
        assert types[column] == kind
    rows = df.collect()
    if name in ("op1_token_store", "op2_toxicity", "op3_surrogates", "op4_language_id", "op6_simhash", "op8_secrets", "op13_runs"):
        docs = spark.read.parquet(f"{SF}/documents.parquet")
        assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in docs.select("doc_id").collect())


def plain_run(docs, labels, benchmark):
    """``(doc_id, start, length, crc)`` of the pipeline's pieces, stage by stage in Python, and the documents kept."""
    scorer = toxicity.fit(docs, labels, learn_from=~toxicity.held_out()).scorer()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["h"]))
    rows = [(r["doc_id"], r["text"]) for r in rows if scorer.document(r["text"] or "")[0] < 0.5]
    fps = [simhash.fingerprint(t or "") for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4 and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    rows = [r for k, r in enumerate(rows) if root[k] == k]
    block = decontam.Block([(r["item_id"], r["text"]) for r in benchmark.collect()])
    rows = [r for r in rows if not block.hits(r[1] or "")]
    scanner, enc = secrets.Scanner(secrets.RULES), PieceEncoder(public_path("byte_bpe_50k.json"))
    want = []
    for doc_id, text in rows:
        parts, end = [], 0
        for a, k, z in scanner.block([text or ""])[0]:
            if a >= end:
                parts += [text[end:a], f"<{secrets.RULES[k].kind}>"]
            end = max(end, z)
        ids = enc.whole("".join(parts) + (text or "")[end:]) + np.array([0], "<u4").tobytes()
        n = len(ids) // 4
        cuts = [0, *range((n - 1) % 2048 + 1, n + 1, 2048)]
        want += [(doc_id, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for a, b in zip(cuts, cuts[1:])]
    return want, rows


def packed(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    return sorted((str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"]) for r in rows)


def as_text(want):
    return sorted((str(d), *r) for d, *r in want)


def test_pipeline_equals_a_plain_run(spark):
    docs, labels, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    want, kept = plain_run(docs, labels, benchmark)
    assert packed(spark, SF) == as_text(want) and 0 < len(kept) < docs.count()


def test_pipeline_on_odd_rows_and_empty_tables(spark, odd_docs, no_docs, tmp_table):
    labels = spark.createDataFrame([(1, 0), (5, 1), (None, 1), (99, None)], "doc_id bigint, toxic int")
    benchmark = spark.createDataFrame([(1, "another text of the same id"), (2, None), (3, ""), (None, "xyz")], "item_id bigint, text string")
    for docs in (odd_docs, odd_docs.unionByName(odd_docs), no_docs):
        for parts in ((labels, benchmark), (labels.limit(0), benchmark.limit(0))):
            folder = tmp_table("corpus")
            for name, df in zip(("documents", "labels", "benchmark"), (docs, *parts)):
                df.write.parquet(f"{folder}/{name}.parquet")
            want, kept = plain_run(docs, *parts)
            assert packed(spark, folder) == as_text(want)
            assert bool(kept) == (docs is not no_docs)


def test_stages_keep_the_columns(spark, odd_docs, no_docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (odd_docs, no_docs):
            assert stage(spark, docs, SF).columns == docs.columns
