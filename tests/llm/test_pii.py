import re

import pytest
from pyspark.sql import functions as F

from layertables.llm import pii

TEXTS = [
    (1, "Write to Ann.Lee@Mail.example.com or ann.lee@mail.example.com, call +1 (622) 555-2314 or +1 622-555-2314."),
    (2, "Card 4785380592391139 and 4785 3805 9239 1139, but 8007782375593431 is none. Host 152.143.123.131, v1.2.3.4.5 and 300.1.1.1"),
    (3, "Mr. John Smith met Mrs. Mary Smith; later Mr. Smith and MRS left. Frau Müller, Mr. JOHN SMITH."),
    (4, "г-н Иванов и г-жа Иванова; Κυρία Παπά"),
    (5, "nobody here, 12-34, a@b, 555-1234"),
    (6, ""), (7, None), (None, "bob@x.org"), (8, "bob@x.org"), (8, "bob@x.org"), (9, "078-05-1120 start@end.io"),
]


@pytest.fixture(scope="module")
def replaced(spark):
    df = spark.createDataFrame([(*r, "extra") for r in TEXTS], "doc_id bigint, text string, kind string")
    return {(r["doc_id"], k): r for k, r in enumerate(sorted(pii.replace(df, "k1").collect(), key=lambda r: str(r)))}


def one(replaced, doc_id):
    return next(r for (i, _), r in replaced.items() if i == doc_id)


def test_nothing_found_stays(replaced):
    assert len(replaced) == len(TEXTS)
    assert one(replaced, 6)["text"] == "" and one(replaced, 7)["text"] is None
    assert one(replaced, 5)["text"] == dict(TEXTS[:7])[5] and one(replaced, 5)["n_entities"] == 0


def test_formats_and_coreference(replaced):
    t = one(replaced, 1)["text"]
    mails = re.findall(r"\S+@\S+\.com", t)
    assert len(mails) == 2 and mails[0].lower() == mails[1].lower() and mails[0].lower() != "ann.lee@mail.example.com"
    assert re.fullmatch(r"[A-Za-z]{3}\.[A-Za-z]{3}@[A-Za-z]{4}\.[A-Za-z]{7}\.com", mails[0])
    phones = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|\+1 \d{3}-\d{3}-\d{4}", t)
    assert len(phones) == 2 and re.sub(r"\D", "", phones[0]) == re.sub(r"\D", "", phones[1]) != "16225552314"
    t = one(replaced, 2)["text"]
    cards = re.findall(r"4\d{3} ?\d{4} ?\d{4} ?\d{4}", t)
    assert len(cards) == 2 and cards[1].replace(" ", "") == cards[0] != "4785380592391139" and cards[1].count(" ") == 3
    digits = [int(c) for c in reversed(cards[0])]
    assert sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0
    assert "8007782375593431 is none" in t and "v1.2.3.4.5 and 300.1.1.1" in t and "152.143.123.131" not in t
    assert one(replaced, 2)["n_entities"] == 3
    assert len({r["text"] for (i, _), r in replaced.items() if i in (None, 8)}) == 1 and "bob" not in one(replaced, 8)["text"]


def test_names_keep_gender_script_and_family(replaced):
    t = one(replaced, 3)["text"]
    john, mary, surname = re.search(r"Mr\. (\w+) (\w+) met Mrs\. (\w+) (\w+); later Mr\. (\w+) and MRS left", t).group(1, 3, 5)
    assert john.endswith("n") and not john.endswith("na") and mary.endswith("na")
    assert t.count(f"{surname}") == 3 and f"Mr. {john.upper()} {surname.upper()}" in t and "Smith" not in t
    t = one(replaced, 4)["text"]
    assert re.fullmatch(r"г-н [А-Я][а-я]+ко и г-жа [А-Я][а-я]+ко; Κυρία [Α-Ω][α-ως]+", t) and "Иванов" not in t


def test_collisions_are_settled(spark):
    # 26 one-letter addresses: drawing by chance must collide, with each other and with originals.
    rows = [(k, f"write {chr(97 + k)}@q.io now") for k in range(26)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    names = pii.assign(pii.mentions(df), "k").collect()
    originals = {r["norm"] for r in names}
    assert len(names) == 26 and len({r["surrogate"] for r in names}) == 26
    assert not originals & {r["surrogate"] for r in names}
    again = {r["norm"]: r["surrogate"] for r in pii.assign(pii.mentions(df), "k").collect()}
    other = {r["norm"]: r["surrogate"] for r in pii.assign(pii.mentions(df), "other").collect()}
    assert again == {r["norm"]: r["surrogate"] for r in names} != other


def test_odd_rows_and_plan(spark, odd_docs, no_docs):
    got = pii.replace(odd_docs, "k")
    assert got.count() == odd_docs.count()
    assert sorted(str(r["text"]) for r in got.collect()) == sorted(str(r["text"]) for r in odd_docs.collect())
    assert pii.replace(no_docs, "k").collect() == []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    both = docs.select("doc_id", F.col("text").alias("old")).join(pii.replace(docs, "key"), "doc_id").collect()
    mail, ip = re.compile(r"[\w.]+@[\w.]+\w"), re.compile(r"(?<![\d.])\d+\.\d+\.\d+\.\d+(?![\d.]*\d)")
    seen: dict = {}
    for r in both:
        for p in (mail, ip):
            a, b = p.findall(r["old"]), p.findall(r["text"])
            assert len(a) == len(b) and not any(x in r["text"] for x in a)
            for x, y in zip(a, b):
                assert seen.setdefault(x, y) == y
        assert r["n_entities"] or r["old"] == r["text"]
    assert len(set(seen.values())) == len(seen) > 30 and not set(seen) & set(seen.values())


PHONES = [
    "+33 6 12 34 56 78", "06 12 34 56 78", "+34 612 34 56 78", "+49 30 1234 56789", "555-123-4567", "+49 (0)30 123456", "0612345678",
    "030/1234567", "(030) 123 4567", "0033 6 12 34 56 78", "+44 20 7946 0958", "612 34 56 78", "91 123 45 67", "555.123.4567", "+34912345678",
]


def test_phone_forms_of_the_tables_languages(spark):
    rows = [(k, f"call {p}, or write") for k, p in enumerate(PHONES)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in pii.replace(df, "k").collect()}
    shape = lambda t: re.sub(r"\d", "9", t)
    for k, p in enumerate(PHONES):
        assert got[k]["kinds"] == ["phone"] and p not in got[k]["text"] and shape(got[k]["text"]) == shape(rows[k][1]), (p, got[k])
    assert "call +33 " in got[0]["text"] and "call 0" in got[1]["text"]
    phones = {re.sub(r"\D", "", r["text"]) for r in got.values()}
    assert len(phones) == len({re.sub(r"\D", "", p) for p in PHONES})


def test_numbers_that_are_no_phones_stay(spark):
    rows = [(0, "on 01.02.2024, 2024-01-15 at 08:30:15, 0.1234567 of 1 000 000, 01/02/2024, 12,345,678 and 1234567 in 3.14159265")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert pii.replace(df, "k").first()["text"] == rows[0][1]


LONG = {
    "dots": "x@" + "a." * 250_000 + "!",
    "labels": "a." * 250_000 + " 1",
    "addresses": "a@b.co " * 70_000,
    "digits": "1" * 500_000,
    "phones": "+" + "1 " * 250_000,
    "plus": "+" * 500_000 + "1",
    "at": "a@" * 250_000,
    "names": "Mr. Smith " * 30_000,
    "letters": "Mr. A" + "b" * 500_000,
    "ip": "1.1.1." * 80_000,
    "underscores": "_-" * 200_000 + "bob@x.org",
}


def test_long_texts_of_every_patterns_own_characters(spark):
    import time

    df = spark.createDataFrame([(k, t) for k, t in enumerate(LONG.values())], "doc_id bigint, text string").repartition(4)
    t0 = time.perf_counter()
    got = {list(LONG)[r["doc_id"]]: r for r in pii.replace(df, "k").collect()}
    assert time.perf_counter() - t0 < 120
    assert got["addresses"]["n_entities"] == 70_000 and "a@b.co" not in got["addresses"]["text"]
    assert got["names"]["n_entities"] == 30_000 and "Smith" not in got["names"]["text"]
    for name in ("dots", "labels", "digits", "plus", "at"):
        assert got[name]["text"] == LONG[name], name
    assert got["underscores"]["text"].startswith("_-" * 200_000) and "bob" not in got["underscores"]["text"]


def test_marks_in_front_of_an_address_are_no_part_of_it(spark):
    rows = [(0, "bob@x.org"), (1, "see...bob@x.org..."), (2, "...bob@x.org"), (3, "_bob@x.org, %bob@x.org"), (4, "bob@x..org")]
    got = {r["doc_id"]: r["text"] for r in pii.replace(spark.createDataFrame(rows, "doc_id bigint, text string"), "k").collect()}
    new = got[0]
    assert new != "bob@x.org" and got[2] == "..." + new and got[3] == f"_{new}, %{new}" and got[4] == "bob@x..org"
