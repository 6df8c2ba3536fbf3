"""Surrogates for personal data, with DataFrame functions only.

Found in whole texts: e-mail addresses, phone numbers (after + or 0, plain or in any
groups, 7 to 15 digits; 3-3-4 numbers; Spanish numbers in groups), card numbers (by their
first and check digits), IPv4 addresses, social security numbers, and names behind a title that tells the
gender. Every entity is brought to a normal form (letters in lower case, digits
without separators), so that all its spellings, in all documents, get one
surrogate; given names and surnames are entities of their own, so "Mr. John Smith"
and "Mr. Smith" keep their surname in common.

A surrogate is drawn from SHA-256 of the secret key, the kind, the normal form and a
try number. It keeps the type and the format: separators, lengths, upper case, the
country code of a phone number, the first digit of a card number and whether its
check digit is right, the top-level domain (and one domain stays one domain), the
script of a name and the gender in its ending.

Collision checks run on the table of distinct entities: a surrogate must not be the
normal form of any entity found, and two entities never share one. Whoever loses
draws again with the next number, until nobody collides; from the fourth try on
letters are added, so that it ends. All this is grouped by surrogate or joined on
normal forms; the texts are shuffled only where they hold an entity.

Defined cases: null text stays null, empty text stays empty; ids may be null or
repeated (equal rows get equal results); an empty table gives no rows; columns
other than id and text are not read. Time is linear in the length of a text, whatever it holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layertables.llm.common import shuffle_partitions, written

# Titles by gender.
MALE = "Mr|Mister|Sir|Herr|Monsieur|Señor|Sr|Don|господин|г-н|Κύριος|Κύριε"
FEMALE = "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Señora|Sra|Doña|госпожа|г-жа|Κυρία"
# Forms of the other kinds, in order of precedence.
# A run of characters is gone through once: from its beginning, with no step back into it, and a
# domain has at most 127 labels (so a loop never nests as deep as a text is long).
LEADING = "[._%+-]*+"  # in front of an address, no part of it
EMAIL = rf"(?<![A-Za-z0-9._%+-]){LEADING}[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){{0,126}}\.[A-Za-z]{{2,}}"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
IPV4 = rf"(?<![\d.]){OCTET}\.{OCTET}\.{OCTET}\.{OCTET}(?!\d|\.\d)"
CARD = r"(?<![\d-])\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}(?![\d-])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
# In order: codes and three groups, any groups after +, 3-3-4, any groups after 0 (no dates), Spanish groups.
PHONE = (
    r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{2,4}(?![ ./-]?\d)"
    r"|\+\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{2,4}(?!\d)|\+1[ .-]?\d{3}[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|\+[1-9](?:[ ./()-]{0,2}\d){6,14}(?!\d)"
    r"|(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\d.,/+-])(?:\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}|\d{3} \d{3} \d{4})(?![\d-]|[.,]\d)"
    r"|(?<![\d.,:/+-])(?!\d{2}[ ./-]\d{2}[ ./-]\d{4}(?!\d))\(?0{1,2}[1-9](?:(?:\) ?|[ ./-])?\d){5,12}(?![\d-]|[.,:]\d)"
    r"|(?<![\d.,/+-])[6-9]\d(?:\d[ .-]\d\d|[ .-]\d{3})[ .-]\d\d[ .-]\d\d(?![\d-]|[.,]\d)"
)
WORD = r"\p{Lu}[\p{L}'’-]+"
NAME = rf"(?=[MHSFDгΚ])(?<![\p{{L}}\d])(?:{FEMALE}|{MALE})\.? {WORD}(?: (?!(?:{FEMALE}|{MALE})(?![\p{{L}}])){WORD})?"
# A look at the next character spares most places the alternatives.
ANY = rf"{EMAIL}|(?=[\d+(])(?:{IPV4}|{CARD}|{SSN}|{PHONE})|{NAME}"
# What every text with an entity holds.
MAYBE = rf"[0-9@]|{NAME}"

# Syllables and gendered endings by script.
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe fi fo ga ge go ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to va ve vi vo".split(),
    "cyrillic": "ба бе би бо да де ди до га го ка ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се си со та те ти то ва ве ви во".split(),
    "greek": "βα βε βι βο γα γε γο δα δε δι δο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε σι σο τα τε τι το".split(),
}
ENDINGS = {
    "given_m": {"latin": "n", "cyrillic": "н", "greek": "ς"},
    "given_f": {"latin": "na", "cyrillic": "на", "greek": "να"},
    "surname": {"latin": "er", "cyrillic": "ко", "greek": "κης"},
}
MORE_AFTER = 3
# Kind of a number that only looks like a card's; it stays as it is.
NONE = "none"


def _kind(raw: Column) -> Column:
    whole = lambda p: raw.rlike(f"^(?:{p})$")
    kinds = [("email", EMAIL), ("ip", r"\d+\.\d+\.\d+\.\d+"), ("card", r"\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}"), ("ssn", r"\d{3}-\d{2}-\d{4}")]
    out = reduce(lambda c, kp: c.when(whole(kp[1]), F.lit(kp[0])), kinds, F.when(F.lit(False), F.lit("")))
    return out.when(raw.rlike(r"^[+(0-9]"), F.lit("phone")).when(raw.rlike(rf"^(?:{FEMALE})\.? "), F.lit("f")).otherwise(F.lit("m"))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")


def mentions(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, key, place, part, prefix, raw, kind, norm``: a row for every part of
    every entity; ``key`` names the document row."""
    text = F.col(text_col)
    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text")).filter(text.rlike(MAYBE))
    found = rows.select("doc_id", _key("doc_id", "text").alias("key"), F.posexplode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("place", "whole"))
    found = found.withColumn("type", _kind(F.col("whole")))
    named = F.col("type").isin("m", "f")
    prefix = F.when(named, F.regexp_extract("whole", r"^\S+ ", 0)).when(F.col("type") == "email", F.regexp_extract("whole", f"^{LEADING}", 0)).otherwise("")
    found = found.withColumn("prefix", prefix).withColumn("whole", F.expr("substring(whole, length(prefix) + 1)"))
    words = F.when(named, F.split("whole", " ")).otherwise(F.array("whole"))
    found = found.select("doc_id", "key", "place", "prefix", "type", F.size(words).alias("n"), F.posexplode(words).alias("part", "raw"))
    named = F.col("type").isin("m", "f")
    role = F.when(F.col("part") == F.col("n") - 1, F.lit("surname")).otherwise(F.concat(F.lit("given_"), "type"))
    kind = F.when(named, F.concat_ws(" ", role, _script(F.col("raw")))).otherwise(F.col("type"))
    digits = F.regexp_replace("raw", "[^0-9]", "")
    norm = F.when(F.col("type").isin("card", "ssn", "phone"), digits).otherwise(F.lower("raw"))
    real = digits.rlike("^[2-6]") & (F.pmod(_luhn(digits), F.lit(10)) == 0)
    kind = F.when((F.col("type") == "card") & ~real, F.lit(NONE)).otherwise(kind)
    return found.select("doc_id", "key", "place", "part", "prefix", "raw", kind.alias("kind"), norm.alias("norm"))


def _key(id_col: str, text_col: str) -> Column:
    """128 bits that name a row by its id and text."""
    return F.struct(F.xxhash64(id_col, text_col).alias("a"), F.xxhash64(F.lit("key"), text_col, id_col).alias("b"))


def _draw(position: Column, modulus) -> Column:
    """A number below ``modulus`` from the hash in column ``h``."""
    at = F.pmod(position * 3, F.lit(120)) + 1
    return F.pmod(F.conv(F.substring(F.col("h"), at, F.lit(5)), 16, 10).cast("bigint") + F.floor(position / 40), modulus)


def _chars(word: Column, one) -> Column:
    """``word`` with every character replaced by ``one(character, its number from 0)``."""
    index = F.sequence(F.lit(1), F.length(word))
    return F.when(F.length(word) > 0, F.array_join(F.transform(index, lambda i: one(F.substring(word, i, F.lit(1)), i - 1)), "")).otherwise("")


def _letter(c: Column, i: Column) -> Column:
    draw = F.when(c.rlike("[a-z]"), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (_draw(i, F.lit(26)) + 1).cast("int"), F.lit(1)))
    return draw.when(c.rlike("[0-9]"), _draw(i, F.lit(10)).cast("string")).otherwise(c)


def _luhn(digits: Column) -> Column:
    """Check sum of a card number; right if a multiple of ten."""
    def term(i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(F.pmod(F.length(digits) - i, F.lit(2)) == 1, d * 2).otherwise(d)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), term), F.lit(0), lambda a, x: a + x)


def _with_surrogate(entities: DataFrame, key: str) -> DataFrame:
    """Adds ``surrogate``, a normal form of the same kind, for columns ``kind, norm, tries``."""
    base = F.concat_ws("|", F.lit(key), "kind", "norm", F.col("tries").cast("string"))
    domain = F.regexp_extract("norm", "@(.*)$", 1)
    e = entities.withColumns(
        {"h": F.concat(F.sha2(base, 256), F.sha2(F.concat_ws("|", base, F.lit("2")), 256)), "hd": F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), domain), 256)}
    )
    norm, h = F.col("norm"), F.col("h")
    digits = _chars(norm, lambda c, i: _draw(i, F.lit(10)).cast("string"))
    more = F.when(F.col("tries") > MORE_AFTER, F.substring(h, F.lit(100), F.col("tries") - MORE_AFTER)).otherwise("")
    letters = F.translate(more, "0123456789", "ghijklmnop")
    # E-mail: the local part from the address, the domain from the domain alone.
    local = F.concat(_chars(F.regexp_extract(norm, "^([^@]*)@", 1), _letter), letters)
    host, top = F.regexp_extract(domain, r"^(.*)\.[^.]+$", 1), F.regexp_extract(domain, r"\.[^.]+$", 0)
    host2 = _chars(host, lambda c, i: F.when(c.rlike("[a-z]"), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (F.pmod(F.conv(F.substring(F.col("hd"), F.pmod(i * 2, F.lit(60)) + 1, F.lit(4)), 16, 10).cast("bigint"), F.lit(26)) + 1).cast("int"), F.lit(1))).otherwise(c))
    email = F.concat(local, F.lit("@"), host2, top)
    octet = lambda i, low, n: (F.lit(low) + _draw(F.lit(i), F.lit(n))).cast("string")
    ip = F.concat_ws(".", octet(0, 11, 89), octet(1, 0, 256), octet(2, 0, 256), octet(3, 1, 254))
    # Card: the first digit stays; the check digit is right or wrong as it was.
    body = F.concat(F.substring(norm, 1, 1), F.substring(digits, 2, 14))
    right = F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10))
    check = F.when(F.pmod(_luhn(norm), F.lit(10)) == 0, right).otherwise(F.pmod(right + 1 + _draw(F.lit(20), F.lit(9)), F.lit(10)))
    card = F.concat(body, check.cast("int").cast("string"))
    # Phone: the country code (what is before the last ten digits, two digits in Europe) or the leading
    # zeros and a leading 2 to 9 stay a phone number.
    wide = F.greatest(F.length(norm) - 10, F.when(norm.rlike("^[34]"), 2).otherwise(0))
    code = F.when(norm.startswith("0"), F.regexp_extract(norm, "^0+", 0)).when(F.length(norm) > 10, F.substring(norm, F.lit(1), wide)).otherwise(F.lit(""))
    rest = F.concat((_draw(F.lit(30), F.lit(8)) + 2).cast("string"), F.substring(digits, F.length(code) + 2, F.length(norm)))
    phone = F.concat(code, rest)
    out = F.when(F.col("kind") == "email", email).when(F.col("kind") == "ip", ip).when(F.col("kind") == "card", card)
    out = out.when(F.col("kind") == "phone", phone).when(F.col("kind") == "ssn", digits)
    for role, endings in ENDINGS.items():
        for script, end in endings.items():
            table = F.array(*map(F.lit, SYLLABLES[script]))
            n = len(SYLLABLES[script])
            count = F.greatest(F.lit(2), F.least(F.lit(6), F.floor(F.length("norm") / 2))) + F.greatest(F.lit(0), F.col("tries") - MORE_AFTER)
            word = F.array_join(F.transform(F.sequence(F.lit(0), (count - 1).cast("int")), lambda i: F.element_at(table, (_draw(i, F.lit(n)) + 1).cast("int"))), "")
            out = out.when(F.col("kind") == f"{role} {script}", F.concat(word, F.lit(end)))
    return e.withColumn("surrogate", out).drop("h", "hd")


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``kind, norm, surrogate`` for distinct ``(kind, norm)``: no surrogate twice in
    a kind, none that is the normal form of an entity."""
    entities = written(entities.select("kind", "norm").distinct(), "entities")
    settled = None
    todo = entities.withColumn("tries", F.lit(0))
    tasks = shuffle_partitions(entities.sparkSession)
    taken_norms = entities.select("kind", F.col("norm").alias("surrogate"))
    while True:
        # Drawing is costly a row, and the table small in bytes: dealt to all tasks, not to as many as its size asks for.
        drawn = written(_with_surrogate(todo.repartition(tasks, "kind", "norm"), key), "drawn")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm"))
        clear = first.join(taken_norms, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            clear = clear.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        clear = written(clear.select("kind", "norm", "surrogate"), "settled")
        settled = clear if settled is None else settled.unionByName(clear)
        todo = written(drawn.join(clear.select("kind", "norm"), ["kind", "norm"], "left_anti").select("kind", "norm", (F.col("tries") + 1).alias("tries")), "todo")
        if todo.isEmpty():
            return settled


def _dress(raw: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the text it replaces."""
    at = lambda i: F.length(F.regexp_replace(F.substring(raw, F.lit(1), i), "[^0-9]", ""))
    numbered = _chars(raw, lambda c, i: F.when(c.rlike("[0-9]"), F.substring(surrogate, at(i + 1), F.lit(1))).otherwise(c))
    capital = F.concat(F.upper(F.substring(surrogate, 1, 1)), F.expr("substring(surrogate, 2)"))
    upper = (raw == F.upper(raw)) & (F.length(raw) > 1)
    word = F.when(upper, F.upper(surrogate)).when(kind == "email", surrogate).otherwise(capital)
    return F.when(kind.isin("card", "ssn", "phone"), numbered).when(kind == "ip", surrogate).otherwise(word)


def replace(df: DataFrame, key: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_entities, kinds``: every whole text with its entities replaced."""
    found = written(mentions(df, id_col=id_col, text_col=text_col), "mentions")
    real = F.col("kind") != NONE
    named = found.filter(real).join(assign(found.filter(real), key), ["kind", "norm"])
    named = named.withColumn("new", _dress(F.col("raw"), F.col("kind"), F.col("surrogate"))).drop("surrogate")
    named = named.unionByName(found.filter(~real).withColumn("new", F.col("raw")))
    # The entities of a row in order, each with its text; every place has one. Equal rows give equal parts.
    parts = F.sort_array(F.collect_set(F.struct("part", "prefix", "new", "kind")))
    dressed = F.transform(parts, lambda p: F.concat(F.when(p.part == 0, p.prefix).otherwise(F.lit(" ")), p.new))
    places = named.groupBy("key", "place").agg(F.array_join(dressed, "").alias("new"), F.element_at(parts, 1).kind.alias("kind"))
    by_row = places.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "new", "kind"))).alias("entities"))
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    has = F.coalesce(F.col("text").rlike(MAYBE) & F.col("text").rlike(ANY), F.lit(False))
    clean = docs.filter(~has).select("doc_id", "text", F.lit(0).alias("n_entities"), F.array().cast("array<string>").alias("kinds"))
    dirty = docs.filter(has).withColumn("key", _key("doc_id", "text")).join(by_row, "key")
    # The gaps between entities, and behind each gap but the last its entity.
    gaps = F.split("text", ANY, -1)
    text = F.array_join(F.transform(F.arrays_zip(gaps.alias("gap"), F.col("entities").alias("e")), lambda z: F.concat(z.gap, F.coalesce(z.e.new, F.lit("")))), "")
    firsts = F.filter("entities", lambda p: p.kind != NONE)
    return clean.unionByName(dirty.select("doc_id", text.alias("text"), F.size(firsts).alias("n_entities"), F.transform(firsts, lambda p: p.kind).alias("kinds")))
