import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from layertables.llm import packing, token_store
from layertables.llm.tokens import PieceEncoder, pieces_of, public_path

NAMES = ("word_bpe_49k.json", "byte_bpe_50k.json")
ENCODERS = {n: PieceEncoder(public_path(n)) for n in NAMES}


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aBcé'ß.,!? \n\t\r0129-_中́İΣ<|>\x0b\x1c\xa0s")), max_size=40), max_size=4))
def test_pieces_equal_whole_text(name, texts):
    e = ENCODERS[name]
    assert e.by_piece
    assert e.encode(texts) == [e.whole(t) for t in texts]


def test_distinct_pieces_are_looked_up_once_a_group_of_texts(monkeypatch):
    e = PieceEncoder(public_path(NAMES[0]))
    asked = []

    class Memo(dict):
        def __getitem__(self, p):
            asked.append(p)
            return super().__getitem__(p)

    e._memo = Memo()
    texts = ["The cat, the dog. A-b,c x1y,z the the", "", "the cat\x0b", "dog. DOG, é!"] * 200
    assert e.encode(texts) == [e.whole(t) for t in texts]
    assert len(asked) == len(set(asked)) < 20
    # Groups end anywhere between texts.
    monkeypatch.setattr("layertables.llm.tokens.GROUP_CHARS", 50)
    assert e.encode(texts) == [e.whole(t) for t in texts]


def test_new_pieces_are_given_to_the_tokenizer_together(monkeypatch):
    e = PieceEncoder(public_path(NAMES[1]))
    tok, given_texts, asked = e._tok, [], []

    class Counting:
        def __getattr__(self, name):
            got = getattr(tok, name)
            return (lambda texts, **kw: given_texts.extend(texts) or got(texts, **kw)) if "batch" in name else got

    class Memo(dict):
        def __getitem__(self, p):
            asked.append(p)
            return super().__getitem__(p)

    e._tok, e._memo = Counting(), Memo()
    odd = ["", " \n", "x", "it's.Then A1b.c, dé.é×.÷; 中。文 中.e\u0301. \r\n\t\U0001f600\U0001f600! ", "end \n", " b", "'s"]
    texts = odd + [" ".join(f"Wört{k}x{i}é, ñ{k * i}'ll" for k in range(40)) for i in range(30)] + odd
    want = [e.whole(t) for t in texts]
    assert e.encode(texts) == want
    assert len(asked) == len(set(asked)) > 1000 and len(given_texts) < 100
    # Any number of pieces together, groups ending anywhere between texts, and a full memo.
    for joined, group, memo in ((1, 50, 1 << 19), (7, 1, 20), (10**6, 1000, 1)):
        monkeypatch.setattr("layertables.llm.tokens.JOINED", joined)
        monkeypatch.setattr("layertables.llm.tokens.GROUP_CHARS", group)
        monkeypatch.setattr("layertables.llm.tokens.MEMO_PIECES", memo)
        e._memo, e._old = {}, {}
        assert e.encode(texts) == want


def test_new_words_are_given_to_the_tokenizer_together(monkeypatch):
    e = PieceEncoder(public_path(NAMES[0]))
    tok, given_texts = e._tok, []

    class Counting:
        def __getattr__(self, name):
            got = getattr(tok, name)
            return (lambda texts, **kw: given_texts.extend(texts) or got(texts, **kw)) if "batch" in name else got

    e._tok = Counting()
    odd = ["", " \n", "x", "it's.Then A1b.c, dé.é×.÷; 中。文 中.e\u0301 \u0301e \u0958x \u1112\u1161\u11ab. İΣ \U0001f600\U0001f600! ", "a\x00 \x00b", "'s 's", "\u0323\u0307a\u0307\u0323 b"]
    texts = odd + [" ".join(f"Wört{k}x{i}é, ñ{k * i}'ll" for k in range(40)) for i in range(30)] + odd
    want = [e.whole(t) for t in texts]
    assert e.encode(texts) == want
    assert len(e._memo) > 1000 and len(given_texts) < 100
    # Any number of words together, groups ending anywhere between texts, and a full memo.
    for joined, group, memo in ((1, 50, 1 << 19), (7, 1, 20), (10**6, 1000, 1)):
        monkeypatch.setattr("layertables.llm.tokens.JOINED", joined)
        monkeypatch.setattr("layertables.llm.tokens.GROUP_CHARS", group)
        monkeypatch.setattr("layertables.llm.tokens.MEMO_PIECES", memo)
        e._memo, e._old = {}, {}
        assert e.encode(texts) == want


def test_cut_of_a_slice_equals_that_of_a_copy():
    texts = pa.array(["skipped. é", "Déjà vu. ", "", " \n", "a.b ×. é.c"], pa.large_string())
    pieces, first = pieces_of(texts[1:])
    assert pieces.to_pylist() == ["Déjà", " vu", ".", " ", " \n", "a", ".b", " ×.", " é", ".c"]
    assert first.tolist() == [0, 4, 4, 5, 10]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
def test_codes_round_trip_and_random_access(ids):
    v = token_store.DacView(token_store.dac_encode(np.array(ids, np.uint32)))
    assert v.all().tolist() == ids
    for i in range(0, len(ids), 37):
        assert v[i] == ids[i]
    with pytest.raises(IndexError):
        v[len(ids)]


def test_store_returns_every_document(spark, odd_docs, tmp_table):
    path, e = tmp_table("store"), ENCODERS[NAMES[0]]
    token_store.write_token_store(odd_docs, path, public_path(NAMES[0]), segment_tokens=500, shards=3)
    got = sorted((tuple(r) for r in token_store.read_documents(spark, path).collect()), key=lambda r: r[1])
    rows = [(r["doc_id"], e.whole(r["text"] or "") + np.array([1], "<u4").tobytes()) for r in odd_docs.collect()]
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    assert sorted((str(i), len(b) // 4, zlib.crc32(b)) for i, b in rows) == sorted((str(r[0]), r[2], r[3]) for r in got)
    at = 0
    for r in got:
        assert r[1] == at
        at += r[2]
    # Any token by its place.
    whole = {}
    for r in got:
        b = next(b for i, b in rows if i == r[0] and zlib.crc32(b) == r[3])
        for k, t in enumerate(np.frombuffer(b, "<u4").tolist()):
            whole[r[1] + k] = t
    places = [0, 1, 7, at // 2, at - 1, at, at + 5, -1]
    df = spark.createDataFrame([(p,) for p in places * 2], "position bigint")
    assert {tuple(r) for r in token_store.tokens_at(spark, path, df).collect()} == {(p, whole[p]) for p in places if p in whole}


@pytest.mark.parametrize("listed", [0, 100])
def test_lookup_reads_the_codes_of_found_segments_only(spark, tmp_table, monkeypatch, listed):
    monkeypatch.setattr(token_store, "LISTED_SEGMENTS", listed)
    path, e = tmp_table("store"), ENCODERS[NAMES[0]]
    docs = spark.range(60).selectExpr("id as doc_id", "repeat(concat('word', id, ' '), 40) as text")
    token_store.write_token_store(docs, path, public_path(NAMES[0]), segment_tokens=90, shards=4)
    ids = [t for r in docs.orderBy("doc_id").collect() for t in [*np.frombuffer(e.whole(r["text"]), "<u4").tolist(), 1]]
    df = spark.createDataFrame([(p,) for p in (0, 5, len(ids) - 1, len(ids), 5)], "position bigint")
    got = token_store.tokens_at(spark, path, df)
    assert sorted(map(tuple, got.collect())) == [(p, ids[p]) for p in (0, 5, len(ids) - 1)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan and "In(shard" in plan) == (listed > 0)


def test_store_of_nothing(spark, no_docs, tmp_table):
    path = tmp_table("store")
    token_store.write_token_store(no_docs, path, public_path(NAMES[0]))
    assert token_store.read_documents(spark, path).collect() == []


def check_packed(rows, want, size):
    assert sorted((str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by: dict = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_packing_places_every_piece(spark, odd_docs):
    e = ENCODERS[NAMES[1]]
    want, total = [], 0
    for r in odd_docs.collect():
        ids = e.whole(r["text"] or "") + np.array([0], "<u4").tobytes()
        n = len(ids) // 4
        total += n
        cuts = [0, *range((n - 1) % 2048 + 1, n + 1, 2048)]
        want += [(str(r["doc_id"]), a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for a, b in zip(cuts, cuts[1:])]
    rows = packing.pack(odd_docs, public_path(NAMES[1])).collect()
    assert check_packed(rows, sorted(want), 2048) <= -(-total // 2048) + 1


def test_packing_nothing(no_docs):
    assert packing.pack(no_docs, public_path(NAMES[1])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_plan_uses_the_histogram_exactly(lengths):
    counts = np.bincount(lengths, minlength=65)
    used = np.zeros(65, int)
    for pattern, repeats in packing.plan_patterns(counts, 64):
        assert repeats > 0 and sum(pattern) <= 64
        for v in pattern:
            used[v] += repeats
    assert used.tolist() == counts.tolist()


def test_plan_is_near_the_bound_and_fit_is_non_negative():
    lengths = np.minimum(np.random.default_rng(0).lognormal(6.6, 0.9, 20000).astype(int) + 1, 2048)
    counts = np.bincount(lengths, minlength=2049)
    sequences = sum(r for _, r in packing.plan_patterns(counts))
    assert sequences <= 1.005 * np.ceil(lengths.sum() / 2048)
    patterns = packing.patterns_of(counts, 2048)
    assert (patterns.sum(1) == 2048).all()
    x = packing.fit_repeats(patterns, counts.astype(float), steps=40)
    assert (x >= 0).all()
    fit = sum(np.bincount(patterns[:, k], x, 2049) for k in range(3))
    assert np.abs(fit - counts)[1:].sum() < 0.3 * counts.sum()


def test_common_length_is_spread(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "'same words here' as text")
    rows = packing.pack(df, public_path(NAMES[1])).collect()
    n = rows[0]["length"]
    assert len({r["sequence_id"] for r in rows}) == -(-3000 // (2048 // n))


def test_places_are_not_broadcast(spark):
    # A plan of one row has as many places as there are pieces.
    df = spark.range(3000).selectExpr("id as doc_id", "'same words here' as text")
    packed = packing.pack(df, public_path(NAMES[1]))
    for rows in (None, 3000):
        assert rows is None or len(packed.collect()) == rows
        plan = packed._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "rank" in x]


def test_repeated_row_is_spread_and_plan_rows_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(packing, "PLAN_REPEATS", 7)
    monkeypatch.setattr(packing, "SALTED_ROWS", 40)
    seen = []
    salted = packing._salted
    monkeypatch.setattr(packing, "_salted", lambda p, n: seen.append(salted(p, n)) or seen[-1])
    df = spark.range(4000).selectExpr("if(id % 3 = 0, id, null) as doc_id", "if(id % 3 = 0, repeat('a b ', int(id % 90)), 'same words here') as text")
    rows = packing.pack(df, public_path(NAMES[1])).collect()
    e = ENCODERS[NAMES[1]]
    want = []
    for r in df.collect():
        ids = e.whole(r["text"]) + np.array([0], "<u4").tobytes()
        want.append((str(r["doc_id"]), 0, len(ids) // 4, zlib.crc32(ids)))
    check_packed(rows, sorted(want), 2048)
    assert seen[0].groupBy("length", "salt").count().agg({"count": "max"}).first()[0] < 200
