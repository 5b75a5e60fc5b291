"""Format-preserving pseudonyms for personal numbers and dates, in DataFrame functions only.

Found values are validated and then permuted, with a key, among the values of
their own format by a Feistel network: a card number stays a number of as many
digits with a right check digit, a date a date. Equal values get equal
pseudonyms in every document, and the key turns them back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
# Formats that are looked for, in this order.
PATTERNS = (
    r"(?<![0-9])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9])",  # date
    r"(?<![0-9])[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}(?![0-9])",  # date
    r"(?<![0-9])[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}(?![0-9])",  # date
    r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",  # social security number
    r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?!\.?[0-9])",  # IPv4 address
    r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])",  # phone number
    r"(?<![0-9])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])",  # phone number
    r"(?<![0-9.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9]|[.-][0-9])",  # phone number
    r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",  # payment card
)
PATTERN = "|".join(PATTERNS)
DATE_FROM, DAYS = "1800-01-01", 146_097  # four hundred years
DAY_PARTS = (189, 773)  # their product is DAYS
YEARS, LEAP_YEARS = 400, 97


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _digest(key: str, kind: str, round_: Column, value: Column) -> Column:
    text = F.concat_ws("|", F.lit(key), F.lit(kind), round_.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, kind: str, back: bool = False) -> Column:
    """A keyed permutation of the pairs (left, right) with left < a and right < b."""

    def step(s: Column, r: Column) -> Column:
        sign = -1 if back else 1
        to_left = F.pmod(s["l"] + sign * F.pmod(_digest(key, kind, r, s["r"]), a), a)
        to_right = F.pmod(s["r"] + sign * F.pmod(_digest(key, kind, r, s["l"]), b), b)
        even = r % 2 == 0
        return F.struct(F.when(even, to_left).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(to_right).alias("r"))

    rounds = F.array(*[F.lit(i) for i in (reversed(range(ROUNDS)) if back else range(ROUNDS))])
    return F.aggregate(rounds, F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), step)


def _power_of_ten(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def permute_digits(digits: Column, key: str, kind: str, back: bool = False) -> Column:
    """Another string of as many digits, of two to eighteen."""

    def permuted(d: Column) -> Column:
        n = F.length(d)
        half = F.floor(n / 2).cast("int")
        left, right = F.substring(d, F.lit(1), half).cast("long"), F.substring(d, half + 1, n - half).cast("long")
        halves = feistel(left, right, _power_of_ten(half), _power_of_ten(n - half), key, kind, back)
        return let(halves, lambda x: F.concat(F.lpad(x["l"].cast("string"), half, F.lit("0")), F.lpad(x["r"].cast("string"), n - half, F.lit("0"))))

    return let(digits, permuted)


def luhn_digit(payload: Column) -> Column:
    """The check digit that belongs behind these digits."""
    digits = F.transform(F.split(F.reverse(payload), ""), lambda x: x.cast("int"))
    doubled = F.transform(digits, lambda x, i: F.when(i % 2 == 1, x).when(x > 4, 2 * x - 9).otherwise(2 * x))
    return F.pmod(-F.aggregate(doubled, F.lit(0), lambda s, x: s + x), F.lit(10)).cast("string")


def into_format(digits: Column, like: Column) -> Column:
    """Put digits in the places of those in ``like``."""

    def put(d: Column) -> Column:
        # marks stand before, between and behind the digits
        return F.array_join(F.zip_with(F.split(like, "[0-9]"), F.split(d, ""), lambda mark, x: F.concat(F.coalesce(mark, F.lit("")), F.coalesce(x, F.lit("")))), "")

    return let(digits, put)


def _permute_day(day: Column, key: str, back: bool) -> Column:
    """Another day of the four hundred years."""
    n = F.datediff(day, F.to_date(F.lit(DATE_FROM)))
    a, b = DAY_PARTS
    out = feistel(F.floor(n / b), n % b, F.lit(a).cast("long"), F.lit(b).cast("long"), key, "date", back)
    return let(out, lambda x: F.date_add(F.to_date(F.lit(DATE_FROM)), (x["l"] * b + x["r"]).cast("int")))


def day_pairs(first: int | None, second: int | None, late: bool = False) -> list[int]:
    """100 * month + day of all days but 29 February that a date of a narrower form can name.

    ``first`` bounds the month and ``second`` the day where they have one digit;
    ``late`` leaves the days from 13 on.
    """
    lengths = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
    return [100 * m + d for m, n in enumerate(lengths, 1) for d in range(13 if late else 1, n + 1) if m <= (first or 12) and d <= (second or 31)]


def _permute_pair(day: Column, pairs: list[int], key: str, back: bool) -> Column:
    """Another day of the four hundred years among those of the pairs; of 29 February another leap year."""
    known = F.split(F.lit(",".join(map(str, pairs))), ",").cast("array<int>")
    year = (F.year(day) - 1800).cast("long")
    at = F.array_position(known, F.month(day) * 100 + F.dayofmonth(day)) - 1
    n = len(pairs)
    moved = feistel(year, at, F.lit(YEARS).cast("long"), F.lit(n).cast("long"), key, f"date{n}", back)
    made = let(moved, lambda x: let(F.element_at(known, (x["r"] + 1).cast("int")), lambda p: F.make_date((x["l"] + 1800).cast("int"), F.floor(p / 100).cast("int"), p % 100)))
    years = F.filter(F.sequence(F.lit(1800), F.lit(2196), F.lit(4)), lambda y: (y % 100 != 0) | (y % 400 == 0))
    other = feistel(F.lit(0).cast("long"), F.array_position(years, F.year(day)) - 1, F.lit(1).cast("long"), F.lit(LEAP_YEARS).cast("long"), key, f"leap{n}", back)
    leapt = let(other, lambda x: F.make_date(F.element_at(years, (x["r"] + 1).cast("int")), F.lit(2), F.lit(29)))
    return F.when(F.month(day) * 100 + F.dayofmonth(day) == 229, leapt).otherwise(made)


def classify(m: Column) -> Column:
    """The kind of a match if it is valid, else null."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    iso = F.try_to_date(m, "yyyy-MM-dd")
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    card = F.substring(digits, -1, 1) == luhn_digit(F.substring(digits, F.lit(1), F.length(digits) - 1))
    area = F.substring(digits, 1, 3)
    return (
        F.when(m.rlike(r"^[0-9]{4}-"), F.when(_in_range(iso) & (F.length(digits) == 8) & m.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), "date"))
        .when(m.rlike(r"^[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}$"), F.when(_in_range(_loose_day(m)), "date"))
        .when(m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), F.when((area != "000") & (area != "666") & (area < "900") & (F.substring(digits, 4, 2) != "00") & (F.substring(digits, 6, 4) != "0000"), "ssn"))
        .when(m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), F.when(F.forall(octets, lambda x: x <= 255), "ip"))
        .when(m.rlike(r"^[+(]|^[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$"), F.when((F.length(digits) >= 8) & (F.length(digits) <= 15), "phone"))
        .when((F.length(digits) >= 13) & (F.length(digits) <= 19), F.when(card, "card"))
    )


def _loose_day(m: Column) -> Column:
    """d.m.yyyy; with slashes m/d/yyyy, or d/m/yyyy where only that is a date."""
    p = F.split(m, "[./]")
    make = lambda d, mo: F.try_to_date(F.concat_ws("-", F.get(p, F.lit(2)), F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    first, second = F.get(p, F.lit(0)), F.get(p, F.lit(1))
    return F.when(m.contains("."), make(first, second)).otherwise(F.coalesce(make(second, first), make(first, second)))


def _moved_day(day: Column, m: Column, key: str, back: bool) -> Column:
    """Another day that is written, and read back, in the form of ``m``.

    A form is the order of day and month and their numbers of digits. What has
    two digits each can name every day, but d/m/yyyy only those from 13 on:
    before, it reads as m/d/yyyy.
    """
    p = F.split(m, "[./]")
    short_a, short_b = F.length(F.get(p, F.lit(0))) == 1, F.length(F.get(p, F.lit(1))) == 1
    dots = m.contains(".")
    late = ~dots & (F.get(p, F.lit(0)).cast("int") > 12)
    out = F.when(m.rlike("^[0-9]{4}-"), _permute_day(day, key, back))
    out = out.when(late & short_b, _permute_pair(day, day_pairs(9, None, True), key, back)).when(late, _permute_pair(day, day_pairs(None, None, True), key, back))
    for month_short, day_short in ((True, True), (True, False), (False, True)):
        own = (F.when(dots, short_b).otherwise(short_a) == month_short) & (F.when(dots, short_a).otherwise(short_b) == day_short)
        out = out.when(own, _permute_pair(day, day_pairs(9 if month_short else None, 9 if day_short else None), key, back))
    return out.otherwise(_permute_day(day, key, back))


def _in_range(day: Column) -> Column:
    n = F.datediff(day, F.to_date(F.lit(DATE_FROM)))
    return (n >= 0) & (n < DAYS)


def _write_day(day: Column, m: Column) -> Column:
    """A day in the format of ``m``."""
    p = F.split(m, "[./]")
    padded = lambda x, like: F.when(F.length(like) == 2, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string"))
    day_first = m.contains(".") | (F.get(p, F.lit(0)).cast("int") > 12)
    d, mo = F.dayofmonth(day), F.month(day)
    first, second = F.when(day_first, d).otherwise(mo), F.when(day_first, mo).otherwise(d)
    mark = F.when(m.contains("."), ".").otherwise("/")
    loose = F.concat(padded(first, F.get(p, F.lit(0))), mark, padded(second, F.get(p, F.lit(1))), mark, F.date_format(day, "yyyy"))
    return F.when(m.rlike("^[0-9]{4}-"), F.date_format(day, "yyyy-MM-dd")).otherwise(loose)


def pseudonym(m: Column, kind: Column, key: str, back: bool = False) -> Column:
    """The pseudonym of a match, or (``back``) the value of a pseudonym; the match itself if it is not valid."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    payload = F.substring(digits, F.lit(1), F.length(digits) - 1)
    card = let(permute_digits(payload, key, "card", back), lambda p: into_format(F.concat(p, luhn_digit(p)), m))

    # a phone number keeps its country code
    code = F.regexp_extract(m, r"^(\+[0-9]{1,3})(?=[ .(-])", 1)
    rest = F.substring(m, F.length(code) + 1, F.length(m))
    phone = F.concat(code, into_format(permute_digits(F.regexp_replace(rest, "[^0-9]", ""), key, "phone", back), rest))

    area = F.substring(digits, 1, 3).cast("int")
    index = (F.when(area > 666, area - 2).otherwise(area - 1) * 99 + F.substring(digits, 4, 2).cast("int") - 1).cast("long")
    s = feistel(index, F.substring(digits, 6, 4).cast("int") - 1, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"), key, "ssn", back)
    pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
    new_area = lambda x: F.floor(x["l"] / 99) + F.when(x["l"] >= 665 * 99, 2).otherwise(1)
    ssn = let(s, lambda x: F.concat_ws("-", pad(new_area(x), 3), pad(x["l"] % 99 + 1, 2), pad(x["r"] + 1, 4)))

    o = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    get = lambda i: F.get(o, F.lit(i))
    i = feistel(get(0) * 256 + get(1), get(2) * 256 + get(3), F.lit(65536).cast("long"), F.lit(65536).cast("long"), key, "ip", back)
    ip = let(i, lambda x: F.concat_ws(".", *[y.cast("string") for side in ("l", "r") for y in (F.floor(x[side] / 256), x[side] % 256)]))

    day = F.when(m.rlike("^[0-9]{4}-"), F.try_to_date(m, "yyyy-MM-dd")).otherwise(_loose_day(m))
    date = let(let(day, lambda d: _moved_day(d, m, key, back)), lambda x: _write_day(x, m))
    return F.when(kind == "card", card).when(kind == "phone", phone).when(kind == "ssn", ssn).when(kind == "ip", ip).when(kind == "date", date).otherwise(m)


KINDS = ("card", "phone", "ssn", "ip", "date")


def pseudonymize(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """doc_id, n_card, n_phone, n_ssn, n_ip, n_date, n_found, text: one row for each row of ``docs``.

    Cards of 13 to 19 digits need a right check digit, addresses four numbers
    to 255, phone numbers 8 to 15 digits, dates a real day from 1800 to 2199;
    what is not valid stays. ``back`` turns pseudonyms back. Null texts stay
    null and have no values; empty texts stay empty. Repeated rows get equal
    results. Dates d/m/yyyy whose first number is a month too read as m/d/yyyy.
    Phone numbers begin with a plus, or have three, three and four digits; other
    national forms stay, as do e-mail addresses and secrets.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    # texts without three digits hold nothing that is looked for
    rows = rows.withColumn("found", F.when(F.col("text").rlike(r"[0-9][^\n]*[0-9][^\n]*[0-9]"), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>")))
    kinds = F.transform("found", lambda m: F.struct(m.alias("m"), classify(m).alias("kind")))
    rows = rows.withColumn("found", kinds)
    changed = F.transform("found", lambda x: pseudonym(x["m"], x["kind"], key, back))
    parts = F.split("text", PATTERN)
    spliced = F.array_join(F.zip_with(parts, changed, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    count = lambda kind: F.coalesce(F.size(F.filter("found", lambda x: x["kind"] == kind)), F.lit(0)).cast("long")
    return rows.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.coalesce(F.size(F.filter("found", lambda x: x["kind"].isNotNull())), F.lit(0)).cast("long").alias("n_found"),
        F.when(F.exists("found", lambda x: x["kind"].isNotNull()), spliced).otherwise(F.col("text")).alias("text"),
    )
