"""Format-preserving pseudonyms: validated numbers, dates and addresses, permuted by a keyed Feistel network.

Every value is read as a number in a domain of A * B values, permuted there, and written back into the
very characters' places it came from: digits stay digits, separators stay. The permutation depends
on the key and the kind of value alone, so equal values get equal pseudonyms in all documents,
also where they are written with other separators, and different values stay different.

====================  ==============================================  ===================================
kind                  taken if                                        permuted
====================  ==============================================  ===================================
payment card          13 to 19 digits with a right Luhn digit         all but the first and the Luhn digit,
                                                                      which is computed anew
phone                 ten digits grouped 3-3-4, or +1 and ten         the ten digits; area and exchange
                      digits in any groups                            in use (200 to 999) stay in use
phone, other "+"      8 to 15 digits in groups                        all but the first two digits
social security no.   3-2-4 digits, an area, group, serial in use     within the numbers in use
IPv4 address          four numbers up to 255                          all 32 bits
date                  y-m-d, d.m.y, m/d/y (d/m/y if no such month),   the day, within 1900-01-01
                      a day of the calendar                           to 2105-05-05
e-mail                a name and a domain                             letters and digits of the name
====================  ==============================================  ===================================

Only DataFrame functions are used. The key is part of the plan: keep plans with a real key private.

Defined results: a null text stays null and an empty one empty; text without such values is unchanged;
values that fail their check are left as they are; very long texts are searched whole; where values could overlap, the one
that starts first is taken, of several kinds the first of e-mail, IPv4, date, social security number, card and phone;
repeated rows get the same text; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 8
DAYS = (250, 300)  # of 1900-01-01 to 2105-05-05
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,10}[A-Za-z]{2,63}"
IPV4 = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"
DATE = r"(?<![\w/.-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\w/-]|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = r"(?<![\w-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])"
NANP = r"(?<![\w+-])(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"
E164 = r"(?<![\w+])\+\d(?:[ .()-]{0,2}\d){7,14}(?![\w-])"
ANY = "|".join((EMAIL, IPV4, DATE, SSN, CARD, NANP, E164))


def _round(key: str, tag: Column, number: Column, half: Column) -> Column:
    """Sixty bits of a keyed hash."""
    text = F.concat_ws(":", F.lit(key), tag, number.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _div(x: Column, by: Column | int) -> Column:
    """Whole quotient; ``/`` would go through double."""
    return F.call_function("div", x, by if isinstance(by, Column) else F.lit(by).cast("long"))


def feistel(x: Column, a: Column, b: Column, key: str, tag: Column) -> Column:
    """A permutation of 0 .. a * b - 1, both at most 2**31; ``tag`` names the domain."""
    def step(s: Column, r: Column) -> Column:
        left, right = s["left"], s["right"]
        return F.when(r % 2 == 0, F.struct(((left + _round(key, tag, r, right) % a) % a).alias("left"), right.alias("right"))) \
            .otherwise(F.struct(left.alias("left"), ((right + _round(key, tag, r, left) % b) % b).alias("right")))
    def permuted(x: Column) -> Column:
        start = F.struct(_div(x, b).alias("left"), F.pmod(x, b).cast("long").alias("right"))
        return F.aggregate(F.array(*[F.lit(r) for r in range(ROUNDS)]), start, step, lambda s: s["left"] * b + s["right"])
    return _let(x, permuted)


def _whole_power(base: int, exponent: Column) -> Column:
    """base ** exponent as a long, exact."""
    return F.element_at(F.array(*[F.lit(base ** k).cast("long") for k in range(1 + (9 if base == 10 else 5))]),
                        (exponent + 1).cast("int"))


def _digit_string(digits: Column, key: str, kind: str) -> Column:
    """A string of up to 18 digits, permuted among those of its length."""
    def permuted(digits: Column) -> Column:
        n = F.length(digits)
        half = F.floor(n / 2)
        new = feistel(digits.cast("long"), _whole_power(10, n - half), _whole_power(10, half), key,
                      F.concat(F.lit(kind), n.cast("string")))
        return F.lpad(new.cast("string"), n, "0")
    return _let(digits, permuted)


def _letter_string(letters: Column, key: str) -> Column:
    """A string of a-z, permuted ten letters at a time among those of its length."""
    def part(own: Column, k: Column) -> Column:
        n = F.length(own)
        number = F.aggregate(F.sequence(F.lit(1), n), F.lit(0).cast("long"),
                             lambda sum_, i: sum_ * 26 + F.ascii(F.substr(own, i, F.lit(1))) - 97)
        half = F.floor(n / 2)
        new = feistel(number, _whole_power(26, n - half), _whole_power(26, half), key,
                      F.concat(F.lit("letters"), n.cast("string"), F.lit("."), k.cast("string")))
        # written back from the last letter to the first
        return F.aggregate(F.sequence(F.lit(1), n), F.struct(new.alias("rest"), F.lit("").alias("done")), lambda s, i: F.struct(
            _div(s["rest"], 26).alias("rest"), F.concat(F.char(s["rest"] % 26 + 97), s["done"]).alias("done")),
            lambda s: s["done"])
    def all_parts(letters: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(0), F.floor((F.length(letters) - 1) / 10).cast("int")),
                             lambda k: F.substr(letters, k * 10 + 1, F.lit(10)))
        return F.when(F.length(letters) == 0, "").otherwise(F.array_join(F.transform(pieces, part), ""))
    return _let(letters, all_parts)


def _written_over(old: Column, pattern: str, new: Column) -> Column:
    """``old`` with its characters of a class replaced, in order, by those of ``new``; capitals stay capitals."""
    def written(both: Column) -> Column:
        old, new = both["old"], both["new"]

        def at(i: Column) -> Column:
            char = F.substr(old, i, F.lit(1))
            rank = F.length(F.regexp_replace(F.substr(old, F.lit(1), i), f"[^{pattern}]", ""))
            fresh = F.substr(new, rank, F.lit(1))
            return F.when(~char.rlike(f"[{pattern}]"), char).when(char.rlike("[A-Z]"), F.upper(fresh)).otherwise(fresh)
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(old)), at), "")
    return _let(F.struct(old.alias("old"), new.alias("new")), written)


def _only(value: Column, kept: str) -> Column:
    return F.regexp_replace(value, f"[^{kept}]", "")


def _luhn_sum(digits: Column) -> Column:
    """Of digits before the check digit: the first from the right counts double."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _luhn_digit(digits: Column) -> Column:
    return F.pmod(10 - _luhn_sum(digits) % 10, F.lit(10)).cast("string")


def _card(value: Column, key: str) -> Column:
    def changed(digits: Column) -> Column:
        n = F.length(digits)
        body = F.substr(digits, F.lit(1), n - 1)
        new = F.concat(F.substr(digits, F.lit(1), F.lit(1)), _digit_string(F.substr(digits, F.lit(2), n - 2), key, "card"))
        new = _let(new, lambda body: F.concat(body, _luhn_digit(body)))
        valid = _luhn_digit(body) == F.substr(digits, n, F.lit(1))
        return F.when(valid, _written_over(value, "0-9", new)).otherwise(value)
    return _let(_only(value, "0-9"), changed)


def _ten_digits(digits: Column, key: str) -> Column:
    """Area, exchange and line, permuted among the numbers whose area and exchange are in use, or not, as these are."""
    def permuted(digits: Column) -> Column:
        area, exchange, line = (F.substr(digits, F.lit(at), F.lit(n)).cast("long") for at, n in ((1, 3), (4, 3), (7, 4)))
        # in use from 200 on
        (low, areas), (least, exchanges) = ((F.when(part < 200, 0).otherwise(200), F.when(part < 200, 200).otherwise(800))
                                            for part in (area, exchange))
        new = feistel(((area - low) * exchanges + exchange - least) * 10_000 + line, areas * 100, exchanges * 100, key,
                      F.concat_ws(".", F.lit("phone"), areas.cast("string"), exchanges.cast("string")))
        return _let(new, lambda new: F.concat(
            F.lpad((_div(new, exchanges * 10_000) + low).cast("string"), 3, "0"),
            F.lpad((_div(new, 10_000) % exchanges + least).cast("string"), 3, "0"), F.lpad((new % 10_000).cast("string"), 4, "0")))
    return _let(digits, permuted)


def _phone(value: Column, key: str) -> Column:
    """By its digits, so that equal numbers are linked however they are grouped."""
    def changed(digits: Column) -> Column:
        n = F.length(digits)
        american = (n == 10) & ~value.startswith("+") | (n == 11) & digits.startswith("1")
        new = F.when(american, F.concat(F.substr(digits, F.lit(1), n - 10), _ten_digits(F.substr(digits, n - 9, F.lit(10)), key))) \
            .otherwise(F.concat(F.substring(digits, 1, 2), _digit_string(F.substr(digits, F.lit(3), n - 2), key, "phone")))
        return F.when(american | n.between(8, 15), _written_over(value, "0-9", new)).otherwise(value)
    return _let(_only(value, "0-9"), changed)


def _ssn(value: Column, key: str) -> Column:
    digits = _only(value, "0-9")
    area, group, serial = (F.substr(digits, F.lit(at), F.lit(n)).cast("long") for at, n in ((1, 3), (4, 2), (6, 4)))
    # areas 1 to 899 without 666, as 0 to 897
    x = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9999 + serial - 1
    def digits_of(new: Column) -> Column:
        index = _div(new, 99 * 9999)
        return F.concat(
            F.lpad((index + F.when(index >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
            F.lpad((_div(new, 9999) % 99 + 1).cast("string"), 2, "0"), F.lpad((new % 9999 + 1).cast("string"), 4, "0"))
    written = _let(feistel(x, F.lit(898), F.lit(99 * 9999), key, F.lit("ssn")), digits_of)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, _written_over(value, "0-9", written)).otherwise(value)


def _ipv4(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))
    x = F.aggregate(parts, F.lit(0).cast("long"), lambda total, p: total * 256 + p)
    written = _let(feistel(x, F.lit(65536), F.lit(65536), key, F.lit("ipv4")), lambda new: F.concat_ws(
        ".", *[(_div(new, 1 << s) % 256).cast("string") for s in (24, 16, 8, 0)]))
    return F.when(F.forall(parts, lambda p: p < 256), written).otherwise(value)


def _date(value: Column, key: str) -> Column:
    first, third = F.substring(value, 1, 2), F.substring(value, 4, 2)
    year = F.substring(value, 7, 4)
    iso, dotted = value.rlike("-"), value.rlike(r"\.")
    months_first = ~iso & ~dotted & first.cast("int").between(1, 12)
    text = F.when(iso, value).when(months_first, F.concat_ws("-", year, first, third)).otherwise(F.concat_ws("-", year, third, first))
    start = F.lit("1900-01-01").cast("date")

    def written(new: Column) -> Column:
        return F.when(iso, F.date_format(new, "yyyy-MM-dd")).when(dotted, F.date_format(new, "dd.MM.yyyy")) \
            .when(months_first, F.date_format(new, "MM/dd/yyyy")).otherwise(F.date_format(new, "dd/MM/yyyy"))

    def changed(day: Column) -> Column:
        new = F.date_add(start, feistel(day, *map(F.lit, DAYS), key, F.lit("date")).cast("int"))
        return F.when((day >= 0) & (day < DAYS[0] * DAYS[1]), _let(new, written)).otherwise(value)
    return _let(F.datediff(F.try_to_date(text, "yyyy-MM-dd"), start).cast("long"), changed)


def _email(value: Column, key: str) -> Column:
    name, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    letters, digits = F.lower(_only(name, "A-Za-z")), _only(name, "0-9")
    name = _written_over(name, "A-Za-z", _letter_string(letters, key))
    long_ = F.length(digits) > 18  # the digits beyond are few and rare: they stand, the ones before change
    new = F.when(F.length(digits) == 0, "").otherwise(
        F.concat(_digit_string(F.when(long_, F.substring(digits, 1, 18)).otherwise(digits), key, "name"),
                 F.when(long_, F.substring(digits, 19, 64)).otherwise("")))
    return F.concat(_written_over(name, "0-9", new), F.lit("@"), domain)


def _pseudonym(value: Column, key: str) -> Column:
    def is_(pattern: str) -> Column:
        return value.rlike(f"^(?:{pattern})$")
    return F.when(value.contains("@"), _email(value, key)).when(is_(IPV4), _ipv4(value, key)) \
        .when(is_(DATE), _date(value, key)).when(is_(SSN), _ssn(value, key)) \
        .when(is_(NANP), _phone(value, key)).when(is_(CARD), _card(value, key)).otherwise(_phone(value, key))


def found_values(text: Column) -> Column:
    """Array of all that looks like a value, valid or not; empty for a null text."""
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    return F.when(text.rlike("[0-9@]"), found).otherwise(F.array().cast("array<string>"))


def pseudonymised(text: Column, key: str) -> Column:
    """The text with every valid value replaced by its pseudonym under ``key``."""
    pieces = F.split(text, ANY, -1)
    parts = F.zip_with(pieces, F.transform(found_values(text), lambda v: _pseudonym(v, key)),
                       lambda piece, new: F.concat(piece, F.coalesce(new, F.lit(""))))
    return F.when(text.rlike("[0-9@]"), F.array_join(parts, "")).otherwise(text)
