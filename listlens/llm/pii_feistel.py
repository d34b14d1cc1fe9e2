"""Format-preserving pseudonyms for personal data by a keyed Feistel network, in SQL expressions.

A pattern finds candidates of each kind; checks tell real values (card numbers by their Luhn sum, bank accounts by
remainder 97, dates by the calendar, addresses by the range of their parts). The characters that carry the
value are permuted by a Feistel network keyed by (key, kind, length, round): the value is cut in two
halves of digits, and round by round one half plus a keyed hash of the other, modulo the half's power of ten,
becomes the new half. That is a permutation of all values of the format, so equal values get equal
pseudonyms in every document, different values different ones, and whoever has the key can undo it.
Separators stay; check digits are computed anew; a date becomes another date of 1900 to 2099, of a day up to the 12th one
up to the 12th, of a later one a later one: so a month-first date stays one and has the pseudonym of its other spellings.

Everything is higher-order functions over the matches of a text: no shuffle, no Python.

Kinds: card (13 to 19 digits, also beside other numbers: a run of digit groups is searched for one group, or groups of
the usual lengths, that pass the check), iban (country, check digits, letters and digits; the letters stay), ssn, phone (7 to 15 digits),
ipv4, date (YYYY-MM-DD, DD.MM.YYYY, DD/MM/YYYY and, where that is no date, MM/DD/YYYY), email (letters and digits before the @ each
stay in their alphabet: a Feistel network whose halves are the two halves of the name).

The key is an argument and must be kept secret: who has it can undo the pseudonyms. A run in which several card
numbers of usual lengths overlap and pass the check is read from the left, when pseudonyms are made and when they are undone.

Defined cases: a null text stays null and has no finds; a number that fails its check stays as it is; texts of any length are searched
whole (a run of digit groups in parts of 400 groups); repeated rows get equal results; other columns, whatever their names,
are not looked at; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: For the query and tests only; a real key comes from the caller.
TEST_KEY = "corpus-pseudonyms-1"
ROUNDS = 8
FIRST_DAY, DAYS = "1900-01-01", 73_049  # to 2099-12-31

# One pattern per kind, tried in this order at each place of a text.
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "date": r"(?<!\d)(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})(?![\d.]\d|\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ipv4": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)",
    # A run of digit groups of 13 digits or more, up to a date or a social security number.
    "card": r"(?<![\d.-])(?=\d(?:[ -]?\d){12})\d{1,99}(?:[ -](?!\d{4}-\d{2}-\d{2}(?!\d)|\d{3}-\d{2}-\d{4}(?!\d)|\d{2}[./]\d{2}[./]\d{4})\d{1,99}){0,399}(?!\d|\.\d)",
}
# The usual groups of card numbers, by how many groups they are, in the order of preference.
CARD_GROUPS = {
    1: r"^\d{13,19}[ -]?$",
    4: r"^\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}[ -]?$",
    3: r"^\d{4}[ -]\d{6}[ -]\d{4,5}[ -]?$",
    5: r"^\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,3}[ -]?$",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def kind_of(found: Column) -> Column:
    """Which pattern a match is of."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(found.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def digits_of(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def _keyed(key: str, kind: Column, length: Column, turn: Column, half: Column) -> Column:
    """A keyed 52-bit number: HMAC-like, the key on both sides."""
    text = F.concat_ws("|", F.lit(key), kind, length.cast("string"), turn.cast("string"), half.cast("string"), F.lit(key))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("bigint")


def _power(n: Column) -> Column:
    return F.pow(F.lit(10), n).cast("bigint")


def feistel(digits: Column, kind: Column, key: str, undo: bool = False) -> Column:
    """The digit string as another one of its length (2 to 30 digits; one digit is rotated by a keyed amount)."""
    n = F.length(digits)
    u, v = F.floor(n / 2).cast("int"), (n - F.floor(n / 2)).cast("int")
    start = F.struct(F.substring(digits, F.lit(1), u).cast("bigint").alias("a"), F.substring(digits, u + 1, v).cast("bigint").alias("b"))

    # Even rounds change the first half, odd ones the second.
    def turn(acc: Column, i: Column) -> Column:
        even = i % 2 == 0
        sign = -1 if undo else 1
        a = F.when(even, F.pmod(acc["a"] + sign * F.pmod(_keyed(key, kind, n, i, acc["b"]), _power(u)), _power(u))).otherwise(acc["a"])
        b = F.when(even, acc["b"]).otherwise(F.pmod(acc["b"] + sign * F.pmod(_keyed(key, kind, n, i, acc["a"]), _power(v)), _power(v)))
        return F.struct(a.alias("a"), b.alias("b"))

    order = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if undo else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    pad = lambda x, m: F.lpad(x.cast("string"), m, "0")
    halves = F.aggregate(order, start, turn, lambda acc: F.concat(pad(acc["a"], u), pad(acc["b"], v)))
    amount = F.pmod(_keyed(key, kind, n, F.lit(0), F.lit(0)), F.lit(10)) * (-1 if undo else 1)
    return F.when(n >= 2, halves).when(n == 1, F.pmod(digits.cast("bigint") + amount, F.lit(10)).cast("string")).otherwise(digits)


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum; a multiple of ten for valid numbers."""
    n = F.length(digits)

    def at(i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda acc, i: acc + F.coalesce(at(i), F.lit(0)))


def remainder_97(account: Column) -> Column:
    """Remainder of a long string of digits and letters, A read as 10 and so on."""

    def step(acc: Column, ch: Column) -> Column:
        code = F.ascii(ch)
        return F.when(ch == "", acc).when(code < 58, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.aggregate(F.split(account, ""), F.lit(0), step)


def _account(found: Column) -> Column:
    """What follows the check digits, without spaces."""
    return F.substring(F.replace(found, F.lit(" "), F.lit("")), F.lit(5), F.length(found))


def _date(found: Column) -> Column:
    iso = F.try_to_timestamp(found, F.lit("yyyy-MM-dd"))
    rest = F.regexp_replace(found, "/", ".")
    american = F.when(found.contains("/"), F.try_to_timestamp(found, F.lit("MM/dd/yyyy")))
    return F.coalesce(iso, F.try_to_timestamp(rest, F.lit("dd.MM.yyyy")), american).cast("date")


def valid(found: Column, kind: Column) -> Column:
    """Whether the value can be what its pattern says."""
    digits = digits_of(found)
    account = F.concat(_account(found), F.substring(found, 1, 4))
    date = _date(found)
    in_range = F.datediff(date, F.to_date(F.lit(FIRST_DAY))).between(0, DAYS - 1)
    return (
        F.when(kind == "card", luhn_sum(digits) % 10 == 0)
        .when(kind == "iban", remainder_97(account) == 1)
        .when(kind == "date", F.coalesce(in_range, F.lit(False)))
        .when(kind == "ipv4", F.forall(F.split(found, r"\."), lambda p: p.cast("int") <= 255))
        .when(kind == "ssn", ~found.rlike("^(000|666|9)") & ~found.rlike("-00-") & ~found.rlike("0000$"))
        .otherwise(kind.isNotNull())
    )


def _refill(found: Column, digits: Column) -> Column:
    """``found`` with its digits replaced in order, everything else in place."""

    def step(acc: Column, ch: Column) -> Column:
        is_digit = ch.rlike("^[0-9]$")
        return F.struct(
            F.concat(acc["out"], F.when(is_digit, F.substring(digits, acc["at"], F.lit(1))).otherwise(ch)).alias("out"),
            (acc["at"] + is_digit.cast("int")).alias("at"),
        )

    return F.aggregate(F.split(found, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step, lambda acc: acc["out"])


def _walk(days: Column, kind: Column, key: str, undo: bool) -> Column:
    """A permutation of the days from FIRST_DAY on: the five-digit permutation is applied until it lands inside again, on the same
    side of the 12th of a month."""
    once = lambda x: feistel(F.lpad(x.cast("string"), 5, "0"), kind, key, undo).cast("int")
    late = lambda x: F.dayofmonth(F.date_add(F.to_date(F.lit(FIRST_DAY)), x)) > 12
    tries = F.sequence(F.lit(1), F.lit(128))
    return F.aggregate(tries, once(days), lambda acc, _: F.when((acc >= DAYS) | (late(acc) != late(days)), once(acc)).otherwise(acc))


def _moved_date(found: Column, kind: Column, key: str, undo: bool) -> Column:
    days = F.datediff(_date(found), F.to_date(F.lit(FIRST_DAY)))
    date = F.date_add(F.to_date(F.lit(FIRST_DAY)), _walk(days, kind, key, undo))
    return (
        F.when(found.contains("-"), F.date_format(date, "yyyy-MM-dd"))
        .when(found.contains("/") & (F.substring(found, 4, 2).cast("int") > 12), F.date_format(date, "MM/dd/yyyy"))
        .when(found.contains("/"), F.date_format(date, "dd/MM/yyyy"))
        .otherwise(F.date_format(date, "dd.MM.yyyy"))
    )


def _moved_email(found: Column, key: str, undo: bool) -> Column:
    """The part before the @ by a Feistel network: in turn, the characters of one half move within their alphabets by keyed hashes of
    the other half and their place."""
    name, host = F.substring_index(found, "@", 1), F.substring_index(found, "@", -1)
    n, sign = F.length(name), -1 if undo else 1
    u = F.floor(n / 2).cast("int")

    def moved(half: Column, other: Column, round_: Column) -> Column:
        def shift(ch: Column, i: Column) -> Column:
            by, at = _keyed(key, F.lit("email"), n, round_, F.concat_ws("|", i.cast("string"), other)), F.ascii(ch)
            move = lambda base, size: F.chr((F.pmod(at - base + sign * F.pmod(by, F.lit(size)), F.lit(size)) + base).cast("bigint"))
            return F.when(ch.rlike("^[a-z]$"), move(97, 26)).when(ch.rlike("^[A-Z]$"), move(65, 26)).when(ch.rlike("^[0-9]$"), move(48, 10)).otherwise(ch)

        return F.array_join(F.transform(F.split(half, ""), shift), "")

    def turn(acc: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, moved(acc["a"], acc["b"], i)).otherwise(acc["a"]).alias("a"), F.when(even, acc["b"]).otherwise(moved(acc["b"], acc["a"], i)).alias("b")
        )

    order = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if undo else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    start = F.struct(F.substring(name, F.lit(1), u).alias("a"), F.substring(name, u + 1, n).alias("b"))
    return F.concat(F.aggregate(order, start, turn, lambda acc: F.concat(acc["a"], acc["b"])), F.lit("@"), host)


_PART = "struct<value:string,kind:string>"


def _cards_of(run: Column) -> Column:
    """A run of digit groups as parts in order: card numbers that pass the check, and the groups around them without a kind."""
    groups = F.regexp_extract_all(run, F.lit(r"\d+[ -]?"), F.lit(0))
    good = lambda x: luhn_sum(digits_of(x)) % 10 == 0

    def step(acc: Column, i: Column) -> Column:
        window = lambda k: F.array_join(F.slice(groups, i, F.lit(k)), "")
        whole = (i == 1) & F.length(digits_of(run)).between(13, 19) & good(run)
        size = F.coalesce(*[F.when(window(k).rlike(shape) & good(window(k)), F.lit(k)) for k, shape in CARD_GROUPS.items()], F.when(whole, F.size(groups)))
        part = F.struct(
            F.when(size.isNull(), F.element_at(groups, i)).otherwise(F.array_join(F.slice(groups, i, F.coalesce(size, F.lit(1))), "")).alias("value"),
            F.when(size.isNotNull(), F.lit("card")).alias("kind"),
        )
        return F.when(i < acc["next"], acc).otherwise(
            F.struct((i + F.coalesce(size, F.lit(1))).alias("next"), F.concat(acc["parts"], F.array(part.cast(_PART))).alias("parts"))
        )

    start = F.struct(F.lit(1).alias("next"), F.array().cast(f"array<{_PART}>").alias("parts"))
    return F.aggregate(F.sequence(F.lit(1), F.size(groups)), start, step, lambda acc: acc["parts"])


def parts_of(found: Column) -> Column:
    """A match as parts of a value and its kind (null where it is none)."""
    kind = kind_of(found)
    one = F.array(F.struct(found.alias("value"), F.when(valid(found, kind), kind).alias("kind")).cast(_PART))
    return F.when(kind == "card", _cards_of(found)).otherwise(one)


def pseudonym(found: Column, kind: Column, key: str, undo: bool = False) -> Column:
    """The pseudonym of a valid value, in its format; ``undo`` gives the value back."""
    digits = digits_of(found)
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    moved = feistel(body, kind, key, undo)
    check = F.pmod(-luhn_sum(F.concat(moved, F.lit("0"))), F.lit(10)).cast("string")
    # Of an account the digits move, the letters stay.
    account = _refill(F.substring(found, F.lit(5), F.length(found)), feistel(digits_of(_account(found)), kind, key, undo))
    number = F.concat(F.replace(account, F.lit(" "), F.lit("")), F.substring(found, 1, 2), F.lit("00"))
    pair = F.lpad((98 - remainder_97(number)).cast("string"), 2, "0")
    # Country codes of phone numbers stay: what follows the + up to a separator.
    code = F.regexp_extract(found, r"^\+\d{1,3}(?=[ .-])", 0)
    local = F.substring(found, F.length(code) + 1, F.length(found))
    octets = F.transform(F.split(found, r"\."), lambda p: p.cast("int"))
    ip = F.aggregate(octets, F.lit(0).cast("bigint"), lambda acc, p: acc * 256 + p)
    return (
        F.when(kind == "card", _refill(found, F.concat(moved, check)))
        .when(kind == "iban", F.concat(F.substring(found, 1, 2), pair, account))
        .when(kind == "date", _moved_date(found, kind, key, undo))
        .when(kind == "ipv4", _walk_ip(ip, kind, key, undo))
        .when(kind == "phone", F.concat(code, _refill(local, feistel(digits_of(local), kind, key, undo))))
        .when(kind == "ssn", _refill(found, _walk_ssn(digits, kind, key, undo)))
        .when(kind == "email", _moved_email(found, key, undo))
        .otherwise(found)
    )


def _walk_ip(ip: Column, kind: Column, key: str, undo: bool) -> Column:
    """A permutation of the 2^32 addresses (ten digits, again until inside), as dotted text."""
    dotted = lambda x: F.concat_ws(".", *[F.pmod(F.shiftright(x, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])
    once = lambda x: feistel(F.lpad(x.cast("string"), 10, "0"), kind, key, undo).cast("bigint")
    return F.aggregate(F.sequence(F.lit(1), F.lit(64)), once(ip), lambda acc, _: F.when(acc >= 1 << 32, once(acc)).otherwise(acc), dotted)


def _walk_ssn(digits: Column, kind: Column, key: str, undo: bool) -> Column:
    """Nine digits, again until they are a number that is given out."""
    once = lambda x: feistel(x, kind, key, undo)
    bad = lambda x: x.rlike("^(000|666|9)") | (F.substring(x, 4, 2) == "00") | (F.substring(x, 6, 4) == "0000")
    return F.aggregate(F.sequence(F.lit(1), F.lit(64)), once(digits), lambda acc, _: F.when(bad(acc), once(acc)).otherwise(acc))


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", undo: bool = False) -> DataFrame:
    """One row per document: (id, text with pseudonyms, finds: array of kind and pseudonym)."""
    text = docs[text_col]
    # Every pattern needs a digit or an @: most texts have none and are not searched further.
    found = docs.select(
        docs[id_col].alias("id"), text.alias("text"), F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).alias("found")
    ).withColumn("between", F.when(F.size("found") > 0, F.split("text", ANY, -1)))
    moved = F.transform(F.transform("found", parts_of), lambda parts: F.transform(parts, lambda x: F.struct(
        x["kind"].alias("kind"), F.when(x["kind"].isNull(), x["value"]).otherwise(pseudonym(x["value"], x["kind"], key, undo)).alias("value")
    )))
    done = found.withColumn("moved", F.when(F.size("found") > 0, moved))
    # As many pieces between as matches and one more, so the two lists interleave.
    whole = F.transform("moved", lambda parts: F.array_join(F.transform(parts, lambda x: x["value"]), ""))
    pieces = F.zip_with("between", whole, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    finds = F.transform(
        F.filter(F.flatten("moved"), lambda x: x["kind"].isNotNull()), lambda x: F.struct(x["kind"].alias("kind"), F.regexp_replace(x["value"], "[ -]$", "").alias("value"))
    )
    return done.select(
        "id", F.when(F.col("moved").isNull(), F.col("text")).otherwise(F.array_join(pieces, "")).alias("text"),
        F.coalesce(finds, F.array().cast("array<struct<kind:string,value:string>>")).alias("finds"),
    )


def _is(kind: str):
    return lambda x: x["kind"] == kind


def op6(docs: DataFrame) -> DataFrame:
    done = pseudonymise(docs, TEST_KEY)
    counts = [F.size(F.filter("finds", _is(k))).cast("bigint").alias(f"n_{k}") for k in PATTERNS]
    return done.select(F.col("id").alias("doc_id"), "text", *counts, F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
