"""Format-preserving pseudonyms by a keyed Feistel network, as column expressions only.

Found are e-mail addresses, bank cards and account numbers with right check digits, social
security numbers, telephone numbers, IPv4 addresses, dates that exist, access keys and
named secrets. Their variable part is permuted within its own format: a card stays a card
with right check digit, a date an existing date, a digit a digit. Equal values get equal
pseudonyms in all documents, however they are punctuated, and different values different
ones; who has the key can turn them back. A number that is not valid stays as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The days of 400 years, after which the calendar repeats: 189 * 773.
FIRST_DAY, YEARS, DAYS_LEFT, DAYS_RIGHT = "1700-01-01", (1700, 2099), 189, 773

OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Kinds in the order they are tried at a place. Runs are possessive or bounded, so that no text takes long.
KINDS = {
    "email": r"(?<![\p{L}\p{M}0-9._%+-])[\p{L}\p{M}0-9._%+-]++@(?:[A-Za-z0-9-]++\.){1,127}[A-Za-z]{2,24}+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "access": r"(?<![A-Za-z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"(?i:(?<![a-z0-9])(?:password|passwd|pwd|token|secret|api[_-]?key))\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_-]{8,128}+",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "date": r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9])",
    "ip": rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])",
    "phone": r"(?<![0-9])(?:\+1[2-9][0-9]{2}|(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-]))[2-9][0-9]{2}[ .-]?[0-9]{4}(?![0-9])",
    "abroad": r"\+[2-9](?:[ .()/-]{0,2}[0-9]){7,14}(?![0-9])",
}
#: Every value begins where no digit stands before, and no letter either unless it begins with a digit or plus.
PATTERN = "(?<![0-9])(?:(?<![A-Za-z])|(?=[0-9+]))(?:" + "|".join(KINDS.values()) + ")"
#: What a text must have at least; most texts are settled by this faster look.
NEEDS = "[0-9@=:]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _shift(key: str, tweak: Column, turn: Column, other: Column, place: Column) -> Column:
    """A keyed number below 2 ** 48 from the half that stays."""
    text = F.concat_ws("|", F.lit(key), tweak, turn.cast("string"), other, place.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def permuted_pair(left: Column, right: Column, lefts: int, rights: int, key: str, tweak: str) -> Column:
    """A permutation of the pairs with 0 <= left < lefts and 0 <= right < rights, as a struct (l, r)."""

    def turn(s: Column, i: Column) -> Column:
        on_left = F.struct(F.pmod(s["l"] + _shift(key, F.lit(tweak), i, s["r"].cast("string"), F.lit(0)), F.lit(lefts).cast("long")).alias("l"), s["r"].alias("r"))
        on_right = F.struct(s["l"].alias("l"), F.pmod(s["r"] + _shift(key, F.lit(tweak), i, s["l"].cast("string"), F.lit(0)), F.lit(rights).cast("long")).alias("r"))
        return F.when(i % 2 == 1, on_left).otherwise(on_right)

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def permuted_text(text: Column, alphabet: Callable[[Column, Column], Column], key: str, tweak: str) -> Column:
    """A permutation of the strings whose character at each place is from ``alphabet(place, character)``.

    The network runs on two halves of places; the half that changes is shifted place
    by place, each within its own alphabet, so a string of any length will do.
    """

    def shifted(side: Column, other: Column, i: Column) -> Column:
        joined = F.array_join(F.transform(other, lambda x: x["n"].cast("string")), ",")
        return let(joined, lambda seen: F.transform(side, lambda x, j: F.struct(F.pmod(x["n"] + _shift(key, F.lit(tweak), i, seen, j), F.length(x["of"]).cast("long")).alias("n"), x["of"].alias("of"))))

    def turn(s: Column, i: Column) -> Column:
        on_left = F.struct(shifted(s["l"], s["r"], i).alias("l"), s["r"].alias("r"))
        on_right = F.struct(s["l"].alias("l"), shifted(s["r"], s["l"], i).alias("r"))
        return F.when(i % 2 == 1, on_left).otherwise(on_right)

    def run(places: Column) -> Column:
        half = F.floor(F.size(places) / 2).cast("int")
        halves = F.struct(F.slice(places, F.lit(1), half).alias("l"), F.slice(places, half + 1, F.size(places) - half).alias("r"))
        done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), halves, turn, lambda s: F.concat(s["l"], s["r"]))
        return F.array_join(F.transform(done, lambda x: F.substring(x["of"], (x["n"] + 1).cast("int"), F.lit(1))), "")

    numbered = F.transform(characters(text), lambda c, i: let(alphabet(i, c), lambda of: F.struct((F.instr(of, c) - 1).cast("long").alias("n"), of.alias("of"))))
    return let(numbered, run)


def by_class(_: Column, c: Column) -> Column:
    """Digits stay digits, lower case stays lower case, upper case stays upper case."""
    return F.when(c.rlike("[0-9]"), F.lit(DIGITS)).when(c.rlike("[a-z]"), F.lit(LOWER)).otherwise(F.lit(UPPER))


def laid_out(layout: Column, payload: Column, kind: str) -> Column:
    """``layout`` with its characters of the class ``kind`` replaced by those of ``payload`` in turn."""

    def put(s: Column, c: Column) -> Column:
        taken = F.struct(F.concat(s["out"], F.substring(payload, s["k"] + 1, F.lit(1))).alias("out"), (s["k"] + 1).alias("k"))
        return F.when(c.rlike(kind), taken).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["k"].alias("k")))

    return F.aggregate(characters(layout), F.struct(F.lit("").alias("out"), F.lit(0).alias("k")), put, lambda s: s["out"])


def only(text: Column, others: str) -> Column:
    return F.regexp_replace(text, others, "")


def luhn(digits: Column) -> Column:
    """The sum whose last digit must be 0."""
    backwards = F.reverse(characters(digits))
    numbers = F.transform(backwards, lambda c, i: let(c.cast("int") * (1 + i % 2), lambda n: F.when(n > 9, n - 9).otherwise(n)))
    return F.aggregate(numbers, F.lit(0), lambda a, n: a + n)


def mod97(account: Column) -> Column:
    """The remainder of the account number as ISO 13616 counts it; 1 is right."""
    moved = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))
    value = lambda c: F.instr(F.lit(DIGITS + UPPER), c) - 1
    return F.aggregate(characters(moved), F.lit(0), lambda a, c: let(value(c), lambda v: F.pmod(a * F.when(v > 9, 100).otherwise(10) + v, F.lit(97))))


def _email(m: Column, key: str) -> Column:
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    # Names are the same in either case, so the pseudonym follows the lower-case form. Letters beyond A-Z stay.
    new = permuted_text(only(F.translate(local, UPPER, LOWER), "[^a-z0-9]"), by_class, key, "email")
    return F.concat(let(new, lambda p: laid_out(local, p, "[A-Za-z0-9]")), F.lit("@"), domain)


def _iban(m: Column, key: str) -> Column:
    def renewed(account: Column) -> Column:
        inner = permuted_text(F.substring(account, F.lit(5), F.length(account)), by_class, key, "iban")
        country = F.substring(account, 1, 2)
        full = let(inner, lambda x: let(F.lpad((98 - mod97(F.concat(country, F.lit("00"), x))).cast("string"), 2, "0"), lambda check: laid_out(m, F.concat(country, check, x), "[A-Z0-9]")))
        return F.when(mod97(account) == 1, full).otherwise(m)

    return let(only(m, "[^A-Z0-9]"), renewed)


def _card(m: Column, key: str) -> Column:
    def renewed(digits: Column) -> Column:
        size = F.length(digits)
        inner = permuted_text(F.substring(digits, F.lit(2), size - 2), lambda i, c: F.lit(DIGITS), key, "card")
        front = F.concat(F.substring(digits, 1, 1), inner)
        full = let(front, lambda x: laid_out(m, F.concat(x, F.pmod(-luhn(F.concat(x, F.lit("0"))), F.lit(10)).cast("string")), "[0-9]"))
        return F.when((luhn(digits) % 10 == 0) & digits.rlike("[1-9]"), full).otherwise(m)

    return let(only(m, "[^0-9]"), renewed)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    left = (area - 1 - (area > 666).cast("int")) * 99 + group - 1

    def shown(p: Column) -> Column:
        first = F.floor(p["l"] / 99).cast("int") + 1
        first = first + (first >= 666).cast("int")
        return F.format_string("%03d-%02d-%04d", first, (p["l"] % 99 + 1).cast("int"), (p["r"] + 1).cast("int"))

    return F.when(valid, let(permuted_pair(left, serial - 1, 898 * 99, 9999, key, "ssn"), shown)).otherwise(m)


def _date(m: Column, key: str) -> Column:
    """Year-month-day, day.month.year, and month/day/year or, where that is no date, day/month/year."""
    iso, dotted = m.rlike("^[0-9]{4}-"), F.substring(m, 3, 1) == "."
    year = F.when(iso, F.substring(m, 1, 4)).otherwise(F.substring(m, 7, 4)).cast("int")
    one = F.when(iso, F.substring(m, 6, 2)).otherwise(F.substring(m, 1, 2)).cast("int")
    two = F.when(iso, F.substring(m, 9, 2)).otherwise(F.substring(m, 4, 2)).cast("int")
    day_first = dotted | (~iso & (one > 12))
    month, day = F.when(day_first, two).otherwise(one), F.when(day_first, one).otherwise(two)

    def renewed(d: Column) -> Column:
        leap = (d["y"] % 4 == 0) & ((d["y"] % 100 != 0) | (d["y"] % 400 == 0))
        length = F.when(d["m"] == 2, F.when(leap, 29).otherwise(28)).when(d["m"].isin(4, 6, 9, 11), 30).otherwise(31)
        valid = d["y"].between(*YEARS) & d["m"].between(1, 12) & d["d"].between(1, length)
        number = F.datediff(F.make_date(d["y"], d["m"], d["d"]), F.lit(FIRST_DAY).cast("date"))

        def shown(p: Column) -> Column:
            new = F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * DAYS_RIGHT + p["r"]).cast("int"))
            us, eu = F.date_format(new, "MM/dd/yyyy"), F.date_format(new, "dd/MM/yyyy")
            return F.when(iso, F.date_format(new, "yyyy-MM-dd")).when(dotted, F.translate(eu, "/", ".")).when(day_first, eu).otherwise(us)

        pair = let(number, lambda n: permuted_pair(F.floor(n / DAYS_RIGHT), n % DAYS_RIGHT, DAYS_LEFT, DAYS_RIGHT, key, "date"))
        return F.when(valid, let(pair, shown)).otherwise(m)

    return let(F.struct(year.alias("y"), month.alias("m"), day.alias("d")), renewed)


def _ip(m: Column, key: str) -> Column:
    def renewed(parts: Column) -> Column:
        left, right = parts[0] * 256 + parts[1], parts[2] * 256 + parts[3]
        octets = lambda n: (F.floor(n / 256).cast("int"), (n % 256).cast("int"))
        return let(permuted_pair(left, right, 65536, 65536, key, "ip"), lambda p: F.format_string("%d.%d.%d.%d", *octets(p["l"]), *octets(p["r"])))

    return let(F.transform(F.split(m, r"\."), lambda x: x.cast("int")), renewed)


def _phone(m: Column, key: str) -> Column:
    """Numbers of the plan with country code 1: neither area nor exchange begins with 0 or 1."""
    prefix = F.regexp_extract(m, r"^(?:\+?1(?=[ .(-])[ .-]?|\+1)?", 0)
    rest = F.substring(m, F.length(prefix) + 1, F.length(m))
    limited = lambda i, c: F.when(i.isin(0, 3), F.lit(DIGITS[2:])).otherwise(F.lit(DIGITS))
    return F.concat(prefix, let(permuted_text(only(rest, "[^0-9]"), limited, key, "phone"), lambda p: laid_out(rest, p, "[0-9]")))


def _abroad(m: Column, key: str) -> Column:
    """Other international numbers keep their first two digits, the country."""
    digits = only(m, "[^0-9]")
    inner = permuted_text(F.substring(digits, F.lit(3), F.length(digits)), lambda i, c: F.lit(DIGITS), key, "abroad")
    return let(F.concat(F.substring(digits, 1, 2), inner), lambda p: laid_out(m, p, "[0-9]"))


def _tail(m: Column, kept: Column, key: str, tweak: str) -> Column:
    rest = F.substring(m, F.length(kept) + 1, F.length(m))
    hexadecimal = lambda i, c: F.when(rest.rlike("^[0-9a-f]+$"), F.lit(DIGITS + LOWER[:6])).otherwise(by_class(i, c))
    return F.concat(kept, let(permuted_text(only(rest, "[^A-Za-z0-9]"), hexadecimal, key, tweak), lambda p: laid_out(rest, p, "[A-Za-z0-9]")))


def pseudonym(match: Column, key: str) -> Column:
    """The pseudonym of one found value, or the value where it is not valid."""
    is_a = lambda kind: match.rlike(f"^(?:{KINDS[kind]})$")
    named = F.regexp_extract(match, r"^[A-Za-z_-]+\s*[=:]\s*[\"']?", 0)
    return (
        F.when(match.contains("@"), _email(match, key))
        .when(is_a("access"), _tail(match, F.substring(match, 1, 4), key, "access"))
        .when(is_a("iban"), _iban(match, key))
        .when(is_a("secret"), _tail(match, named, key, "secret"))
        .when(is_a("card"), _card(match, key))
        .when(is_a("ssn"), _ssn(match, key))
        .when(is_a("date"), _date(match, key))
        .when(is_a("ip"), _ip(match, key))
        .when(is_a("phone"), _phone(match, key))
        .otherwise(_abroad(match, key))
    )


def pseudonymised(text: Column, key: str) -> Column:
    """``text`` with every found value replaced. Null stays null, a text without any is returned as it is."""
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    between = F.split(text, PATTERN, -1)
    new = F.transform(found, lambda m: pseudonym(m, key))
    mixed = F.zip_with(between, new, lambda gap, value: F.concat(gap, F.coalesce(value, F.lit(""))))
    return F.when(text.rlike(NEEDS) & text.rlike(PATTERN), F.array_join(mixed, "")).otherwise(text)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in its text; all other columns and all rows unchanged.

    Lengths in characters stay the same but for the digits of IPv4 addresses. The key
    decides all pseudonyms: take it from a secret store and keep event logs private,
    for it is part of the plan. No shuffle; nothing is broadcast.
    """
    return docs.withColumns({text: pseudonymised(F.col(f"`{text}`"), key)})


def pii_counts(text: Column) -> Column:
    """Values found in ``text``, valid or not; none in null."""
    found = F.size(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    return F.when(text.rlike(NEEDS), found).otherwise(0).cast("long")
