"""The prefix trie against a plain dictionary of prefixes, and the contraction alone on trees."""

import hashlib
import random
import zlib

import pytest

from layertables.llm import prefix_trie as T

DDL = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    by = {}
    for c, t, r, x in rows:
        if c is not None:
            by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [v[2:] for v in sorted(t)] for c, t in by.items()}
    seq = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seq[c] = own.get(c - c % 100, [])[:h] + v[h:]
    members, kids = {}, {}
    for c, v in seq.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        below = kids.get(k, [])
        leaves[k] = sum(leaves[x] for x in below) if below else 1
        saved[k] = (len(members[k]) - 1) * (len(k[-1][1]) if k else 0) + sum(saved[x] for x in below)
    for k, m in members.items():
        ids = ",".join(map(str, sorted(c for c in m if len(seq[c]) == len(k))))
        up = min(members[k[:-1]]) if k else None
        out.append((min(m), len(k), up, len(m), len(kids.get(k, [])), leaves[k], saved[k], hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def trie(spark, rows, ddl=DDL):
    got = T.build(*T.rebuilt(spark.createDataFrame(rows, ddl))).collect()
    return sorted((tuple(r) for r in got), key=lambda r: r[:2])


def _rows(rng):
    out = []
    for c in rng.sample(range(0, 420), 60) + [-7, 100, 200, 10**15]:
        for t in range(rng.randrange(1, 9)):
            out.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "\U0001f600", None])))
    return out


def test_random_conversations(spark):
    rng = random.Random(4)
    rows = _rows(rng)
    rows += rows[:20]  # repeated rows are turns of their own
    rows += [(None, 1, "user", "no id")]
    # A conversation that begins with others' turns and is hundreds of turns long.
    rows += [(300, t, "user", str(t % 7)) for t in range(300)] + [(301, t, "user", str(t % 7)) for t in range(290)]
    assert trie(spark, rows) == brute(rows)


def test_many_equal_and_many_children(spark, monkeypatch):
    monkeypatch.setattr(T, "ID_BITS", 3)  # the ids of a node come in many blocks
    monkeypatch.setattr(T, "BLOCK_TURNS", 2)
    rows = [(c, t, "user", "same") for c in range(300) for t in range(3)]
    rows += [(1000 + c, t, "user", "same" if t == 0 else f"{c}") for c in range(200) for t in range(7)]
    assert trie(spark, rows) == brute(rows)


def test_defined_cases(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 0, "user", "x")]) == []
    # Own turns are all replaced, and there is no conversation to take them from: the root alone.
    lone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    assert trie(spark, [(lone, 0, "user", "x")]) == brute([(lone, 0, "user", "x")]) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    long = "é" * 200_000
    clash = [(c, t, "user", long, c, t, "x") for c in (0, 1, 2) for t in range(8)]
    got = trie(spark, clash, DDL + ", depth bigint, position bigint, status string")
    assert got == brute([r[:4] for r in clash]) and got[0][6] > 0


@pytest.mark.parametrize("shape", ["chain", "star", "random", "caterpillar"])
def test_contraction_sums(spark, shape):
    rng = random.Random(9)
    up = {0: None}
    for k in range(1, 240):
        up[k] = {"chain": k - 1, "star": 0, "random": rng.randrange(k), "caterpillar": k - 1 if k % 3 else max(0, k - 2)}[shape]
    depth, kids = {0: 0}, dict.fromkeys(up, 0)
    for k in range(1, 240):
        depth[k] = depth[up[k]] + 1
        kids[up[k]] += 1
    rows = [(k, depth[k], up[k], None if up[k] is None else depth[up[k]], kids[k], k + 1) for k in up]
    df = spark.createDataFrame(rows, "conv_id bigint, depth bigint, up_conv bigint, up_depth bigint, n_children bigint, v bigint")
    want = {k: k + 1 for k in up}
    for k in sorted(up, key=lambda k: -depth[k]):
        if up[k] is not None:
            want[up[k]] += want[k]
    got = {r["conv_id"]: r["v"] for r in T.subtree_sums(df, ["v"]).collect()}
    assert got == want


def test_a_chain_halves_in_every_round(spark, monkeypatch):
    rounds = []
    one = T._round
    monkeypatch.setattr(T, "_round", lambda live, k: rounds.append(k) or one(live, k))
    n = 256
    rows = [(k, k, k - 1 if k else None, k - 1 if k else None, int(k < n - 1), 1) for k in range(n)]
    df = spark.createDataFrame(rows, "conv_id bigint, depth bigint, up_conv bigint, up_depth bigint, n_children bigint, v bigint")
    T.subtree_sums(df, ["v"]).count()
    assert len(rounds) <= 12
