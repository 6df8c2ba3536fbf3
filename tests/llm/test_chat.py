import random

from layertables.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    convs: dict = {}
    for c, turn, role, text in set(rows):
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    seqs = {c: tuple((r, t) for *_, r, t in sorted(v)) for c, v in convs.items()}
    proper = {s[:k] for s in seqs.values() for k in range(1, len(s))}
    out: dict = {}
    for c, s in sorted(seqs.items(), key=lambda x: (x[0] is None, x[0] or 0)):
        if s not in proper:
            out.setdefault(s, [c, 0])[1] += 1
    return {c: (len(s), n, "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in s)) for s, (c, n) in out.items()}


def run(spark, rows, **more):
    return {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()}


def check(spark, rows):
    got = run(spark, rows)
    assert {c: (r["n_turns"], r["n_copies"], r["text"]) for c, r in got.items()} == brute(rows)
    return got


def test_snapshots_collapse(spark):
    rng = random.Random(2)
    rows = []
    for c in range(120):
        base = rng.randrange(12)
        n = rng.randint(1, 8)
        rows += [(c, k, "user" if k % 2 == 0 else "assistant", f"{base if k else 0} says {k}") for k in range(n)]
    got = check(spark, rows)
    for r in got.values():
        parts = [r["text"][s["start"] : s["end"]] for s in r["answers"]]
        assert len(parts) == r["n_turns"] // 2 and all(" says " in p and "<" not in p for p in parts)


def test_odd_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (2, 0, None, ""), (None, 0, "user", "x"), (None, 1, "assistant", None)]
    check(spark, rows)
    assert run(spark, []) == {}


def test_turns_of_one_number_are_in_order_of_role_and_text(spark):
    rng = random.Random(5)
    rows = [(c, rng.choice([None, 0, 1, 2]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "é", "\U0001f600x", ""])) for c in range(30) for _ in range(8)]
    for r in check(spark, rows).values():
        head = "<|im_start|>assistant\n"
        want = []
        for part in r["text"].split("<|im_end|>\n")[:-1]:
            if part.startswith(head):
                want.append(part[len(head) :])
        assert [r["text"][s["start"] : s["end"]] for s in r["answers"]] == want


def test_long_conversation_is_numbered_by_blocks(spark):
    n = 2 * chat.BLOCK_TURNS + 10
    rows = [(1, k, "user", str(k % 7)) for k in range(n)] + [(2, k, "user", str(k % 7)) for k in range(n - 3)] + [(3, k + 5, "user", str(k % 7)) for k in range(9)]
    got = run(spark, rows)
    assert set(got) == {1} and got[1]["n_turns"] == n


def test_registered_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    check(spark, [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
