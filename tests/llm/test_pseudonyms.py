import hashlib
import math
import random
import re
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from upswing.llm.pseudonyms import permuted, pseudonymised


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def made(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r["text"], r["private_kinds"]) for r in pseudonymised(df, **options).orderBy("doc_id").collect()]


@pytest.mark.parametrize("limit", [1, 2, 3, 7, 10, 1000, 73_049])
def test_permutation_of_the_whole_range(spark, limit):
    df = spark.range(limit).withColumn("n", F.lit(limit).cast("long"))
    seen = [r[0] for r in df.select(F.expr(permuted("id", "n", "'t'", "k"))).collect()]
    assert sorted(seen) == list(range(limit))
    if limit >= 1000:
        assert sum(i == x for i, x in enumerate(seen)) < 20


def test_formats_hold_and_values_stay_linked(spark):
    one, two, three = made(spark, [
        "card 4845168114407329, 4845-1681-1440-7329; no card 9807915762804490.",
        "+1 (017) 555-7713 and +1 017 555 7713 on 1980-02-29 or 29/02/1980, 1981-02-29 is none",
        "97.51.17.173 300.1.1.1 123-45-6789 666-45-6789 000-12-3456",
    ])
    cards = [c.replace("-", "") for c in re.findall(r"\d[\d-]{15,}", one[0])]
    assert cards[0] == cards[1] != "4845168114407329" and luhn(cards[0]) and cards[0][0] == "4"
    assert cards[2] == "9807915762804490" and one[1] == ["card", "card"]
    match = re.fullmatch(
        r"\+1 \((\d{3})\) (\d{3})-(\d{4}) and \+1 (\d{3}) (\d{3}) (\d{4}) on (\d{4})-(\d\d)-(\d\d) or"
        r" (\d\d)/(\d\d)/(\d{4}), 1981-02-29 is none", two[0],
    )
    parts = match.groups()
    assert parts[:3] == parts[3:6] != ("017", "555", "7713") and parts[6:9] == parts[11:8:-1]
    assert re.fullmatch(r"\d+\.\d+\.\d+\.\d+ 300\.1\.1\.1 \d{3}-\d\d-\d{4} 666-45-6789 000-12-3456", three[0])
    assert three[1] == ["ip", "ssn"]


def test_addresses_and_keys(spark):
    hexed = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    mail, key, loud = made(spark, [
        "to of.55@mail9.example.com. Of.55@mail9.example.com, x@y z", f'token = "{hexed}" not {hexed}',
        f'TOKEN = "{hexed.upper()}"!!',
    ])
    match = re.fullmatch(r"to ([a-z]{2}\.\d\d)@mail9\.example\.com\. (.*)@mail9\.example\.com, x@y z", mail[0])
    assert match[1] == match[2] != "of.55"
    changed = re.match(r'token = "([0-9a-f]{40})"', key[0])[1]
    assert changed != hexed and key[0].endswith(f"not {hexed}") and key[1] == ["key"]
    assert loud[0] == f'TOKEN = "{changed.upper()}"!!'


def test_different_values_differ_and_keys_matter(spark):
    cards = []
    for i in range(300):
        body = f"4{i:014d}"
        cards.append(body + next(c for c in "0123456789" if luhn(body + c)))
    one = [t for t, _ in made(spark, cards)]
    assert len(set(one)) == 300 and all(luhn(c) and len(c) == 16 for c in one)
    assert sum(a == b for a, b in zip(one, (t for t, _ in made(spark, cards, key="it's another \\ key")))) == 0


def test_generated_documents_keep_everything_else(docs):
    rows = docs.withColumn("old", F.col("text")).withColumn("private_kinds", F.lit(1))
    kinds = Counter()
    for row in pseudonymised(rows).collect():
        kinds.update(row["private_kinds"])
        assert len(row["text"]) == len(row["old"]) or "ip" in row["private_kinds"]
        if not row["private_kinds"]:
            assert row["text"] == row["old"]
        for value in re.findall(r"[\w.]+@[\w.]+|(?<!\d)\d{16}(?!\d)|\+1 \(\d{3}\) \d{3}-\d{4}", row["old"]):
            if not value.isdigit() or luhn(value) and value[0] == "4":
                assert value not in row["text"]
            elif not luhn(value) or value[0] in "0178":
                assert value in row["text"]
    assert set(kinds) >= {"card", "phone", "email", "ip"}


def test_odd_tables(odd_docs, no_docs):
    rows = {(r["doc_id"], r["text"]) for r in pseudonymised(odd_docs).collect()}
    assert rows == {(r["doc_id"], r["text"]) for r in odd_docs.collect()}
    assert pseudonymised(no_docs).count() == 0


def test_no_python_and_no_shuffle(docs):
    plan = pseudonymised(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan and "MapIn" not in plan


def test_cards_next_to_other_numbers(spark):
    card, other = "4111 1111 1111 1111", "4845168114407329"
    texts = [
        f"{card} 12/27", "pay 4111111111111111 123 now", f"order 2024 {card} ok", f"{card} 2024-01-02",
        f"{card} {other} 7", f"{card} 12x", f"{card} 12.50", f"{card} 12.a@x.com", f"{card} 123-45-6789",
        f"12/27 {card}", f"{card}-99", "4111 1111 1111 1112 12/27", "1 " * 3000, f"{card} 31/12/1980",
    ]
    rows = made(spark, texts)
    linked = re.match(r"[\d ]{19}", rows[0][0])[0].replace(" ", "")
    assert luhn(linked) and linked != "4111111111111111"
    for text, (new, kinds) in zip(texts[:11], rows[:11]):
        assert "4111111111111111" not in re.sub("[ -]", "", new) and linked in re.sub("[ -]", "", new), text
        assert kinds[0] == "card" and len(new) == len(text)
    assert rows[0][0].endswith(" 12/27") and rows[1][0] == f"pay {linked} 123 now"
    assert rows[2][0].startswith("order 2024 ") and rows[2][0].endswith(" ok")
    assert rows[3][1] == ["card", "date"] and "2024-01-02" not in rows[3][0]
    assert rows[4][1] == ["card", "card"] and other not in rows[4][0] and rows[4][0].endswith(" 7")
    assert rows[5][0].endswith(" 12x") and rows[6][0].endswith(" 12.50")
    assert rows[7][1] == ["card", "email"] and rows[8][1] == ["card", "ssn"]
    assert rows[11] == (texts[11], []) and rows[12] == (texts[12], []) and rows[13][1] == ["card", "date"]


def test_dates_with_the_month_first(spark):
    rows = made(spark, ["12/31/1980 1980-12-31 31/12/1980", "13/32/1980 12.31.1980"])
    month, iso, day = rows[0][0].split()
    year, m, d = iso.split("-")
    assert rows[0][1] == ["date"] * 3 and iso != "1980-12-31"
    assert month == f"{m}/{d}/{year}" and day == f"{d}/{m}/{year}"
    assert rows[1] == ("13/32/1980 12.31.1980", [])


def test_tables_of_numbers_stay(spark):
    pick = random.Random(4)
    tables = [
        [str(pick.randint(1900, 2030)) for _ in range(2000)],
        [str(pick.randrange(10, 10 ** pick.randint(2, 5))) for _ in range(20_000)],
        [str(n) for n in range(1000, 3000)],
        [f"{pick.randrange(200, 1000)}-{pick.randrange(1000, 10_000)}" for _ in range(1000)],
        [f"{pick.randrange(10**4):04d}" for _ in range(2000)],
        [str(1_700_000_000_000 + pick.randrange(10**9)) for _ in range(1000)],
        [f"{pick.randrange(10**6):06d}" for _ in range(2000)],
    ]
    for numbers in tables:
        for joined in (" ".join(numbers), "\n".join(" ".join(numbers[i : i + 7]) for i in range(0, len(numbers), 7))):
            ((text, _),) = made(spark, [joined])
            changed = sum(a != b for a, b in zip(joined.split(), text.split()))
            assert changed < len(numbers) / 1000, (numbers[:5], changed)


def test_shapes_and_issuers_of_cards(spark):
    def checked(body):
        return body + next(c for c in "0123456789" if luhn(body + c))

    visa, amex, diners, union = map(checked, ("411111111111222", "37144963539843", "3056930902590", "620000000000000123"))

    def grouped(digits, *sizes, by=" "):
        parts, at = [], 0
        for size in sizes:
            parts.append(digits[at : at + size])
            at += size
        return by.join(parts)

    cards = [visa, grouped(visa, 4, 4, 4, 4), grouped(visa, 4, 4, 4, 4, by="-"), grouped(amex, 4, 6, 5),
             grouped(diners, 4, 6, 4, by="-"), grouped(union, 4, 4, 4, 4, 3), union, amex,
             f"{grouped(visa, 4, 4, 4, 4)} {grouped(visa, 4, 4, 4, 4)}"]
    for card, (text, kinds) in zip(cards, made(spark, [f"a {c}, b" for c in cards])):
        assert text != f"a {card}, b" and set(kinds) == {"card"}, card
        assert re.sub(r"\d", "9", text) == re.sub(r"\d", "9", f"a {card}, b")
        digits = re.sub(r"\D", "", text)
        assert luhn(digits[:16] if len(kinds) > 1 else digits)
        kept = 1 if card[0] == "4" else 4
        assert digits[:kept] == re.sub(r"\D", "", card)[:kept]
    others = [grouped(visa, 4, 4, 4, 4).replace(" ", "-", 1), grouped(visa, 3, 5, 4, 4), checked("198720011999202"),
              checked("90000000000000"), grouped(visa, 2, 2, 4, 4, 4), checked("1234567890123456789")]
    assert made(spark, others) == [(t, []) for t in others]


def plain_permuted(number, limit, tweak, key):
    """The Feistel network once more, in plain Python."""
    p = math.ceil(math.sqrt(limit))
    q = (limit + p - 1) // p
    x = number
    while True:
        a, b = divmod(x, q)
        for i in range(1, 9):
            parts = "|".join(map(str, (key, tweak, limit, i, b if i % 2 else a)))
            digest = int(hashlib.sha256(parts.encode()).hexdigest()[:15], 16)
            if i % 2:
                a = (a + digest % p) % p
            else:
                b = (b + digest % q) % q
        x = a * q + b
        if x < limit:
            return x


def test_pseudonyms_are_those_of_a_plain_computation(spark):
    pick, key = random.Random(8), "a key"
    texts, expected = [], []
    for _ in range(40):
        body = "4" + "".join(pick.choices("0123456789", k=14))
        card = body + next(c for c in "0123456789" if luhn(body + c))
        new = "4" + f"{plain_permuted(int(card[1:15]), 10**14, 'card0', key):014d}"
        texts.append(card)
        expected.append(new + next(c for c in "0123456789" if luhn(new + c)))
        day = date(1900, 1, 1) + timedelta(pick.randrange(73_049))
        moved = plain_permuted((day - date(1900, 1, 1)).days, 73_049, "date0", key)
        texts.append(day.isoformat())
        expected.append((date(1900, 1, 1) + timedelta(moved)).isoformat())
        octets = [pick.randrange(256) for _ in range(4)]
        number = plain_permuted(int.from_bytes(bytes(octets)), 2**32, "ip0", key)
        texts.append(".".join(map(str, octets)))
        expected.append(".".join(map(str, number.to_bytes(4))))
        area, group, serial = pick.choice([1, 665, 667, 899]), pick.randint(1, 99), pick.randint(1, 9999)
        number = ((area - (2 if area > 666 else 1)) * 99 + group - 1) * 9999 + serial - 1
        number = plain_permuted(number, 898 * 99 * 9999, "ssn0", key)
        high = number // (99 * 9999)
        texts.append(f"{area:03d}-{group:02d}-{serial:04d}")
        expected.append(f"{high + (2 if high >= 665 else 1):03d}-{number // 9999 % 99 + 1:02d}-{number % 9999 + 1:04d}")
        phone = "".join(pick.choices("0123456789", k=10))
        texts.append(f"+49 {phone[:3]} {phone[3:6]}-{phone[6:]}")
        phone = f"{plain_permuted(int(phone), 10**10, 'phone0', key):010d}"
        expected.append(f"+49 {phone[:3]} {phone[3:6]}-{phone[6:]}")
        hexed = "".join(pick.choices("0123456789abcdef", k=32))
        pieces = [hexed[i : i + 10] for i in range(0, 32, 10)]
        turned = "".join(
            f"{plain_permuted(int(x, 16), 16 ** len(x), f'key{i}', key):0{len(x)}x}" for i, x in enumerate(pieces)
        )
        texts.append(f"token={hexed}")
        expected.append(f"token={turned}")
    assert [t for t, _ in made(spark, texts, key=key)] == expected


def test_columns_with_clashing_names(spark):
    docs = spark.createDataFrame(
        [(1, "call +1 017 555 7713", "f", ["m"], 5, "x")],
        "doc_id long, text string, found string, made array<string>, private_kinds int, `_found` string",
    )
    row = pseudonymised(docs).first()
    assert row["found"] == "f" and row["made"] == ["m"] and row["_found"] == "x"
    assert row["private_kinds"] == ["phone"] and row["text"] != "call +1 017 555 7713"
