from __future__ import annotations

import hashlib
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tabwright.llm import pseudonyms as p

KEY = "k"


def round_(tag, number, half):
    return int(hashlib.sha256(f"{KEY}:{tag}:{number}:{half}".encode()).hexdigest()[:15], 16)


def feistel(x, a, b, tag, back=False):
    left, right = divmod(x, b)
    for r in reversed(range(8)) if back else range(8):
        sign = -1 if back else 1
        if r % 2 == 0:
            left = (left + sign * round_(tag, r, right) % a) % a if not back else (left - round_(tag, r, right)) % a
        else:
            right = (right + round_(tag, r, left)) % b if not back else (right - round_(tag, r, left)) % b
    return left * b + right


def digits(text, kind, back=False):
    n = len(text)
    return str(feistel(int(text), 10 ** (n - n // 2), 10 ** (n // 2), f"{kind}{n}", back)).zfill(n)


def american(ten, back=False):
    area, exchange, line = int(ten[:3]), int(ten[3:6]), int(ten[6:])
    (low, areas), (least, exchanges) = ((200, 800) if part >= 200 else (0, 200) for part in (area, exchange))
    new = feistel(((area - low) * exchanges + exchange - least) * 10_000 + line, areas * 100, exchanges * 100,
                  f"phone.{areas}.{exchanges}", back)
    return f"{new // 10_000 // exchanges + low:03}{new // 10_000 % exchanges + least:03}{new % 10_000:04}"


def luhn(body):
    total = sum(sum(divmod(int(c) * (2 - k % 2), 10)) for k, c in enumerate(reversed(body)))
    return str(-total % 10)


def replaced(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.x for r in docs.select("i", p.pseudonymised(F.col("text"), KEY).alias("x")).orderBy("i").collect()]


def test_digits_equal_plain_feistel_and_go_back(spark):
    values = ["4041894974608795", "4111111111111111"]
    new = replaced(spark, values)
    for old, got in zip(values, new):
        body = old[0] + digits(old[1:-1], "card")
        assert got == body + luhn(body)
        assert got[0] + digits(got[1:-1], "card", back=True) == old[:-1]
    assert replaced(spark, ["+1 (988) 555-2485"])[0].translate(str.maketrans("", "", "+() -")) == "1" + american("9885552485")
    assert replaced(spark, ["10.20.30.40"])[0] == ".".join(
        str(b) for b in feistel(0x0A141E28, 65536, 65536, "ipv4").to_bytes(4, "big"))
    day = feistel((date(2020, 2, 29) - date(1900, 1, 1)).days, 250, 300, "date")
    assert (date.fromisoformat(replaced(spark, ["2020-02-29"])[0]) - date(1900, 1, 1)).days == day


@pytest.mark.parametrize("size,a,b", [(1000, 25, 40), (75_000, *p.DAYS), (100, 10, 10)])
def test_permutations(spark, size, a, b):
    new = p.feistel(F.col("id"), F.lit(a), F.lit(b), KEY, F.lit("t"))
    low, high, n = spark.range(size).select(new.alias("y")).agg(F.min("y"), F.max("y"), F.count_distinct("y")).first()
    assert (low, high, n) == (0, size - 1, size)


def test_formats_and_links(spark):
    texts = [
        "Card 4041894974608795, 4041-8949-7460-8795 and 4041 8949 7460 8795.",
        "+1 (988) 555-2485 or (988) 555-2485 or 988-555-2485",
        "ssn 123-45-6789; on 2020-02-29, 29.02.2020, 02/29/2020",
        "Bosbt.42@mail8.example.com bosbt.42@mail8.example.com",
        "+33 6 12 34 56 78 4041894974608795",
    ]
    new = replaced(spark, texts)
    shape = re.compile(r"\d")
    for old, got in zip(texts[:3], new):
        assert shape.sub("9", old) == shape.sub("9", got) and old != got
    cards = re.findall(r"\d[\d -]+\d", new[0])
    assert len({re.sub(r"\D", "", c) for c in cards}) == 1 and luhn(re.sub(r"\D", "", cards[0])[:-1]) == cards[0][-1]
    assert len({re.sub(r"\D", "", x)[-10:] for x in new[1].split(" or ")}) == 1
    iso, dotted, slashed = re.findall(r"\d{4}-\d\d-\d\d|\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4}", new[2])
    assert iso == f"{dotted[6:]}-{dotted[3:5]}-{dotted[:2]}" == f"{slashed[6:]}-{slashed[:2]}-{slashed[3:5]}"
    first, second = new[3].split()
    assert first.lower() == second and first[0].isupper() and second.endswith("@mail8.example.com")
    assert "4041894974608795" not in new[4] and "612345678" not in re.sub(r"\D", "", new[4])


def test_rest_stays(spark):
    texts = [None, "", "no numbers", "4041894974608796 000-11-2222 999.1.1.1 v1.2.3.4.5 2020-02-30 version 2.0", "5 @ home, 100%",
             "1" * 100_000, "a@b", "é ü 12 ß"]
    assert replaced(spark, texts) == texts
    assert replaced(spark, []) == []


def test_many_values_in_a_long_text(spark):
    text = "x 4041894974608795\n" * 20_000
    new = replaced(spark, [text, "4041894974608795"])
    assert new[0] == text.replace("4041894974608795", new[1])


@pytest.mark.parametrize("ten", ["4155552671", "0155552671", "4151552671", "0990000000", "9999999999", "2002000000"])
def test_a_phone_number_has_one_pseudonym_in_all_layouts(spark, ten):
    a, b, c = ten[:3], ten[3:6], ten[6:]
    layouts = [f"+1 {a}-{b}-{c}", f"+1{ten}", f"+1 {ten}", f"+1 ({a}) {b}-{c}", f"+1-{a}-{b}-{c}", f"+1.{a}.{b}.{c}", f"+1 {a} {b} {c}",
               f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}"]
    got = replaced(spark, layouts)
    assert [re.sub(r"\d", "9", x) for x in got] == [re.sub(r"\d", "9", x) for x in layouts]
    assert {re.sub(r"\D", "", x)[-10:] for x in got} == {american(ten)}
    assert american(american(ten), back=True) == ten
    assert [x >= "200" for x in (a, b)] == [x >= "200" for x in (american(ten)[:3], american(ten)[3:6])]


def test_other_countries_keep_two_digits(spark):
    got = replaced(spark, ["+33 6 12 34 56 78", "+33612345678", "+1 234 567", "+1234567890123456"])
    assert re.sub(r"\D", "", got[0]) == re.sub(r"\D", "", got[1]) == "33" + digits("612345678", "phone")
    assert got[2:] == ["+1 234 567", "+1234567890123456"]
