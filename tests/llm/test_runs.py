"""Periodic runs against a brute-force search of every period."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from layertables.llm import runs as R


def brute(words) -> list[tuple[int, int, int]]:
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= max(12 - q, q):
                s, e = i, j + q
                if not any(words[s : e - d] == words[s + d : e] for d in range(1, q)):
                    out.append((s, e - s, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _text(rng: random.Random) -> list[bytes]:
    letters = rng.choice([1, 2, 3, 5, 50])
    noise = lambda n: [rng.randrange(letters) for _ in range(n)]
    kind = rng.randrange(6)
    if kind == 0:
        out = noise(rng.randrange(260))
    elif kind == 1:  # one run between noise
        b = noise(rng.randrange(1, 90))
        out = noise(30) + (b * 5)[: rng.randrange(1, 5 * len(b) + 1)] + noise(30)
    elif kind == 2:  # two phases of one short period: runs across the break
        b = noise(rng.randrange(1, 20))
        out = (b * 40)[: rng.randrange(10, 120)] + (b * 40)[: rng.randrange(10, 120)]
    elif kind == 3:  # Fibonacci words: runs of many periods
        x, out = [0], [0, 1]
        while len(out) < rng.randrange(20, 300):
            x, out = out, out + x
    elif kind == 4:  # runs inside runs
        b = [0] * rng.randrange(1, 60) + [1] + [0] * rng.randrange(1, 60) + [2, 3] * rng.randrange(0, 20)
        out = (b * 4)[:300]
    else:
        b = noise(rng.randrange(1, 12)) * rng.randrange(1, 9) + [7] * rng.randrange(3)
        out = (b * rng.randrange(1, 6))[:300]
    return [str(x).encode() for x in out]


@pytest.mark.parametrize("seed", range(4))
def test_all_runs_of_many_texts(seed):
    rng = random.Random(seed)
    texts = [_text(rng) for _ in range(120)]
    assert R.runs_of(texts) == [brute(t) for t in texts]


def test_long_periods_across_all_scales():
    rng = random.Random(3)
    for period in (15, 16, 31, 32, 63, 64, 200, 511, 512, 700):
        b = [str(rng.randrange(1000)).encode() for _ in range(period)]
        t = [b"x", b"y"] + (b * 3)[: 2 * period + 12] + [b"z"]
        assert (2, 2 * period + 12, period) in R.runs_of([t])[0]
        cut = [b"x"] + (b * 2)[: 2 * period - 1] + [b"z"]  # one word short of a run
        assert not [r for r in R.runs_of([cut])[0] if r[2] == period]


def test_groups_do_not_change_results(monkeypatch):
    rng = random.Random(11)
    texts = [_text(rng) for _ in range(60)]
    whole = R.runs_of(texts)
    monkeypatch.setattr(R, "GROUP_WORDS", 200)
    assert R.runs_of(texts) == whole


def test_collapse_keeps_the_first_period():
    t = b"a b c a b c a b c a b c a b end".split()
    assert R.runs_of([t])[0] == [(0, 14, 3)]
    assert R.collapse(t, [(0, 14, 3)]) == b"a b c end"


def test_time_grows_with_the_words_of_periodic_texts():
    def seconds(n):
        t = (b"p q r s t u v w x y z 1 2 3 4 5 6 7 8 9 ".split() * n)[:n]
        t0 = time.perf_counter()
        assert R.runs_of([t])[0] == [(0, n, 20)]
        return time.perf_counter() - t0

    seconds(20_000)
    assert seconds(400_000) < 100 * max(seconds(20_000), 0.01)


def _want(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[0] if runs else (None, None, None)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (
        doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


COLS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def _key(row):
    return tuple((x is not None, x) for x in row)


def test_query_equals_brute_force_on_whole_table(spark):
    import __spark_entry__ as e

    sf = "/root/testdata/sf0.001"
    got = e.queries()["op13_runs"](spark, sf).select(*COLS).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    short = {r["doc_id"] for r in docs if len((r["text"] or "").split()) < 1500}  # brute force is quadratic
    want = [_want(r["doc_id"], r["text"]) for r in docs if r["doc_id"] in short]
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    assert sorted((tuple(r) for r in got if r["doc_id"] in short), key=_key) == sorted(want, key=_key)
    assert sum(r["n_runs"] > 0 for r in got) > 5


def test_defined_cases(spark, odd_docs, no_docs):
    found = R.detect(odd_docs, prepare=R.tail_repeats)
    got = R.digest(found).collect()
    want = []
    for r in odd_docs.select("doc_id", "text").collect():
        if r["doc_id"] == 6 and len(r["text"]) > 5000:  # "the lazy dog" 9,000 times
            want.append(None)
        else:
            want.append(_want(r["doc_id"], r["text"]))
    plain = [tuple(r) for r in got if r["n_runs"] != 1 or r["length"] != 27000]
    assert len(got) == len(want) == odd_docs.count()
    assert sorted(plain, key=_key) == sorted([w for w in want if w], key=_key)
    assert R.digest(R.detect(no_docs)).collect() == []
    long = [r for r in got if r["length"] == 27000]
    assert [(r["n_runs"], r["start"], r["period"]) for r in long] == [(1, 0, 3)] or len(plain) == len(got)
