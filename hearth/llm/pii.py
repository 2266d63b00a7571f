"""Format-preserving Feistel pseudonyms (operator 1, DataFrame operations only).

Found, validated and replaced by a keyed permutation of their own format:

* card numbers (Luhn), which stay valid cards of their length;
* IPv4 addresses, and IPv6 addresses, full or with ``::``, in the groups as
  written;
* social-security numbers in three groups, with ``-`` or a space;
* phone numbers: ``+`` and 8 to 15 digits, compact or in groups (the country
  code stays), and national ones of ten digits such as (415) 555-2671,
  415-555-2671 and 415.555.2671;
* dates: 1999-12-31, and d/m/yyyy with or without leading zeros; a second part
  over 12 makes it m/d/yyyy, and such dates are permuted among themselves;
* names of e-mail addresses, with letters of any script;
* IBANs (mod 97), whose check digits are made anew.

Bare runs of nine or ten digits are not taken for anything. Separators stay in
place. The permutation is an alternating Feistel network on Z_a x Z_b with
a * b the exact size of the format (or on two halves of a name), so no two
values share a pseudonym, and equal values get equal pseudonyms in every
document. All of it is one expression per row: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
DAYS_FROM, N_DAYS = "1800-01-01", 146_097       # 400 years: 189 * 773 days
LATE = 9833                                      # 9 * 9833 of them have a day over 12

GROUPED = r"\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}"

PATTERNS = {
    "email": r"(?<![\p{L}\p{N}_])[\p{L}\p{N}_][\p{L}\p{N}._%+-]{0,63}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "phone": r"(?<![\w+])(?:" + GROUPED + r"|\+\d{8,15}|\+\d{1,3}(?:[ .-]?\(\d{1,4}\)[ .-]?|[ .-])\d{1,8}(?:[ .-]\d{2,6}){0,4})(?!\d)"
             r"|(?<![\w+.-])(?:\(\d{3}\)[ .-]?\d{3}[ .-]|\d{3}-\d{3}-|\d{3}\.\d{3}\.)\d{4}(?![\w-])",
    "ssn": r"(?<![\w-])(?:\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4})(?![\w-])",
    "date": r"(?<![\w/-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4})(?![\w/-])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ipv6": r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\w)",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])",
}
ANY = "|".join(PATTERNS.values())

# fixed values: country codes of one and of two digits; all others have three
ONE_DIGIT_CODES = r"^[17]"
TWO_DIGIT_CODES = r"^(?:2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
# code points that are shifted among themselves, (first, size): digits and the two cases of a script
CLASSES = [(0x30, 10), (0x61, 26), (0x41, 26), (0xE0, 23), (0xF8, 8), (0xC0, 23), (0xD8, 7), (0x100, 128),
           (0x3B1, 25), (0x391, 17), (0x3A3, 7), (0x430, 32), (0x410, 32), (0x5D0, 27), (0x621, 26), (0x3041, 86),
           (0x30A1, 90), (0x4E00, 20_992), (0xAC00, 11_172)]
HEX = [(0x30, 10), (0x61, 6), (0x41, 6)]


def _let(value: Column, use) -> Column:
    """``use(value)``, evaluated once however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _round(key: str, kind: str, size, i: Column, x: Column) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), F.lit(size) if isinstance(size, int) else size, i, x), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str, left: Column, right: Column, a, b) -> Column:
    """Permute the pair (left, right) of Z_a x Z_b; a struct of both."""
    a, b = (F.lit(x).cast("long") if isinstance(x, int) else x.cast("long") for x in (a, b))

    def step(s, i):
        even = (i % 2) == 0
        return F.struct(
            F.when(even, (s["l"] + _round(key, kind, a, i, s["r"])) % a).otherwise(s["l"]).alias("l"),
            F.when(even, s["r"]).otherwise((s["r"] + _round(key, kind, b, i, s["l"])) % b).alias("r"))
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def _permute_digits(key: str, kind: str, digits: Column) -> Column:
    """A digit string of up to 34 digits: halves of n // 2 and the rest."""
    n = F.length(digits)
    h = F.floor(n / 2).cast("int")
    out = feistel(key, kind, F.substring(digits, F.lit(1), h), F.substring(digits, h + 1, n), _power(h), _power(n - h))
    return _let(out, lambda o: F.concat(F.lpad(o["l"].cast("string"), h, "0"), F.lpad(o["r"].cast("string"), n - h, "0")))


def _digit_sum(digits: Column, doubled: int) -> Column:
    """Luhn's sum; every second digit from the right counts double, the last
    one if ``doubled`` is 0, else the one before."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        two = ((F.length(digits) - i) % 2) == doubled
        return total + F.when(two, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
    return F.aggregate(places, F.lit(0), add)


def _fill(template: Column, places: str, new: Column) -> Column:
    """Put the characters of ``new`` into the template's places of that class."""
    def place(c, i):
        before = F.length(F.regexp_replace(F.substring(template, F.lit(1), i + 1), "[^" + places + "]", ""))
        return F.when(c.rlike("[" + places + "]"), F.substring(new, before, F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.split(template, ""), place), "")


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, r"\D", "")


def _card(key: str, v: Column) -> Column:
    def changed(digits):
        body = _permute_digits(key, "card", F.substring(digits, F.lit(1), F.length(digits) - 1))
        return _let(body, lambda b: _let(F.concat(b, ((10 - _digit_sum(b, 0) % 10) % 10).cast("string")), lambda d: _fill(v, "0-9", d)))
    return _let(_digits(v), lambda d: F.when(_digit_sum(d, 1) % 10 == 0, changed(d)).otherwise(v))


def _phone(key: str, v: Column) -> Column:
    """The digits behind the country code are permuted; codes of one digit have
    ten such digits."""
    plus = v.startswith("+")

    def changed(digits):
        n = F.length(digits)
        code = (F.when(~plus, 0).when(digits.rlike(ONE_DIGIT_CODES), 1).when(digits.rlike(TWO_DIGIT_CODES), 2).otherwise(3))
        valid = F.when(~plus, n == 10).otherwise(n.between(8, 15) & ((code != 1) | (n == 11) | v.rlike("^" + GROUPED + "$")))
        new = F.concat(F.substring(digits, F.lit(1), code), _let(F.substring(digits, code + 1, n), lambda x: _permute_digits(key, "phone", x)))
        return F.when(valid, _let(new, lambda d: _fill(v, "0-9", d))).otherwise(v)
    return _let(_digits(v), changed)


def _ip(key: str, v: Column) -> Column:
    def changed(o):
        part = [o[k].cast("int") for k in range(4)]
        out = feistel(key, "ip", part[0] * 256 + part[1], part[2] * 256 + part[3], 65536, 65536)
        new = _let(out, lambda x: F.concat_ws(".", *[p.cast("string") for p in (
            F.floor(x["l"] / 256), x["l"] % 256, F.floor(x["r"] / 256), x["r"] % 256)]))
        return F.when((F.greatest(*part) <= 255) & ~v.rlike(r"(^|\.)0\d"), new).otherwise(v)
    return _let(F.split(v, r"\."), changed)


def _ssn(key: str, v: Column) -> Column:
    # areas 001-899 without 666, groups 01-99, serials 0001-9999
    area, group, serial = (F.substring(v, at, n).cast("int") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    out = feistel(key, "ssn", place * 99 + group - 1, serial - 1, 898 * 99, 9999)

    def written(o):
        at = F.floor(o["l"] / 99)
        new = [F.when(at >= 665, at + 2).otherwise(at + 1), o["l"] % 99 + 1, o["r"] + 1]
        return _fill(v, "0-9", F.concat(*[F.lpad(x.cast("string"), w, "0") for x, w in zip(new, (3, 2, 4))]))
    return F.when(valid, _let(out, written)).otherwise(v)


def _date(key: str, v: Column) -> Column:
    """Dates over a span of 400 years. Those in the order m/d/yyyy have a day
    over 12 and are numbered without the first twelve days of each month, so
    that their pseudonyms can be read in that order only."""
    start = F.lit(DAYS_FROM).cast("date")
    slash = v.contains("/")

    def day_of(month):      # its first day's number in the span, and in the numbering of m/d dates
        day = F.datediff(F.add_months(start, month.cast("int")), start)
        return day, day - 12 * month

    def changed(p):
        first, second, year = (F.get(p, F.lit(k)) for k in range(3))
        month_first = slash & (second.cast("int") > 12)
        iso = F.when(month_first, F.concat_ws("-", year, first, second)).when(slash, F.concat_ws("-", year, second, first)).otherwise(v)

        def write(new, order):      # with leading zeros unless a part of the value has one digit
            d = F.date_format(new, order)
            return F.when(slash & (F.length(v) < 10), F.regexp_replace(d, r"(^|/)0", "$1")).otherwise(d)

        def by_day(day):
            out = feistel(key, "date", F.floor(day / 773), day % 773, 189, 773)
            return _let(out, lambda o: _let(F.date_add(start, (o["l"] * 773 + o["r"]).cast("int")), lambda new: F.when(
                slash, write(new, "dd/MM/yyyy")).otherwise(F.date_format(new, "yyyy-MM-dd"))))

        def by_late_day(day):
            number = day - 12 * ((year.cast("int") - 1800) * 12 + first.cast("int"))
            out = feistel(key, "late date", F.floor(number / LATE), number % LATE, 9, LATE)

            def date(k):            # months are close to equal: the guess is off by one at most
                guess = F.floor(k / (9 * LATE / 4800))
                month = F.when(day_of(guess + 1)[1] <= k, guess + 1).when(day_of(guess)[1] <= k, guess).otherwise(guess - 1)
                return _let(month, lambda m: F.date_add(start, (k - day_of(m)[1] + 12 + day_of(m)[0]).cast("int")))
            return _let(out, lambda o: _let(o["l"] * LATE + o["r"], lambda k: _let(date(k), lambda new: write(new, "MM/dd/yyyy"))))
        return _let(F.datediff(iso.try_cast("date"), start), lambda day: F.when(
            day.between(0, N_DAYS - 1), F.when(month_first, by_late_day(day)).otherwise(by_day(day))).otherwise(v))
    return _let(F.split(v, "/"), changed)


def _permute_name(key: str, kind: str, name: Column, classes=CLASSES) -> Column:
    """A Feistel network of a name's two halves: characters are shifted within
    their class by a stream keyed with the other half."""
    def shift(half: Column, other: Column, i: Column) -> Column:
        stream = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i, other), 256)

        def one(c, k, s):
            x = F.conv(F.substring(s, (k % 31) * 2 + 1, F.lit(3)), 16, 10).cast("int")
            code = F.ascii(c)
            out = c
            for low, size in reversed(classes):
                at = (code - low + x) % size + low
                new = F.char(at) if low + size <= 128 else F.decode(F.unhex(F.lpad(F.hex(at), 4, "0")), "UTF-16BE")
                out = F.when(code.between(low, low + size - 1), new).otherwise(out)
            return out
        return F.when(F.length(half) == 0, half).otherwise(_let(stream, lambda s: F.array_join(
            F.transform(F.split(half, ""), lambda c, k: one(c, k, s)), "")))

    def step(s, i):
        even = (i % 2) == 0
        return F.struct(F.when(even, shift(s["l"], s["r"], i)).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise(shift(s["r"], s["l"], i)).alias("r"))
    h = F.floor(F.length(name) / 2).cast("int")
    start = F.struct(F.substring(name, F.lit(1), h).alias("l"), F.substring(name, h + 1, F.length(name)).alias("r"))
    return _let(F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step), lambda o: F.concat(o["l"], o["r"]))


def _email(key: str, v: Column) -> Column:
    """The name before the @."""
    return F.concat(_permute_name(key, "email", F.substring_index(v, "@", 1)), F.lit("@"), F.substring_index(v, "@", -1))


def _iban(key: str, v: Column) -> Column:
    """Country code and account; the two check digits follow from both."""
    def check(country, account):
        def add(total, c):
            n = F.ascii(c)
            return F.when(n < 65, (total * 10 + n - 48) % 97).otherwise((total * 100 + n - 55) % 97)
        rest = F.aggregate(F.split(F.concat(account, country, F.lit("00")), ""), F.lit(0), add)
        return F.lpad((98 - rest).cast("string"), 2, "0")

    def changed(c):
        country, account = F.substring(c, 1, 2), F.substring(c, F.lit(5), F.length(c))
        new = _let(_permute_name(key, "iban", account), lambda a: F.concat(country, check(country, a), a))
        return F.when(check(country, account) == F.substring(c, 3, 2), _let(new, lambda x: _fill(v, "A-Z0-9", x))).otherwise(v)
    return _let(F.regexp_replace(v, " ", ""), changed)


def _ipv6(key: str, v: Column) -> Column:
    """The hexadecimal digits as written; letters only is no address."""
    valid = v.rlike(r"\d") & (F.size(F.split(v, ":+")) <= F.when(v.contains("::"), 7).otherwise(8))
    new = _permute_name(key, "ipv6", F.regexp_replace(v, ":", ""), HEX)
    return F.when(valid, _let(new, lambda x: _fill(v, "0-9A-Za-z", x))).otherwise(v)


def pseudonym(key: str, v: Column) -> Column:
    """The pseudonym of one found value; values that fail validation stay."""
    return (F.when(v.contains("@"), _email(key, v))
            .when(v.startswith("+") | v.startswith("(") | v.rlike(r"^\d{3}[.-]\d{3}[.-]\d{4}$"), _phone(key, v))
            .when(v.contains(":"), _ipv6(key, v)).when(v.rlike(r"^[A-Z]"), _iban(key, v))
            .when(v.contains("/") | v.rlike(r"^\d{4}-\d\d-\d\d$"), _date(key, v))
            .when(v.rlike(r"^\d{3}[ -]\d\d[ -]\d{4}$"), _ssn(key, v))
            .when(v.contains("."), _ip(key, v)).otherwise(_card(key, v)))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """One row per input row: ``row`` (the input row without its text),
    ``text`` with all validated values replaced, ``n_replaced``.

    A null text stays null with 0 replacements, an empty one empty. Texts of
    any length are searched whole. Repeated rows and columns of any name do no
    harm; an empty table gives an empty result.
    """
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"),
                      F.col(f"`{text_col}`").alias("t"))
    found = src.withColumn("found", F.regexp_extract_all("t", F.lit("(" + ANY + ")"), 1))
    changed = found.withColumn("new", F.transform("found", lambda v: pseudonym(key, v)))
    # what stands between the values is the text split at them
    between = F.split(F.col("t"), ANY, -1)
    whole = F.concat(F.array_join(F.zip_with(F.slice(between, F.lit(1), F.size("new")), F.col("new"), lambda a, b: F.concat(a, b)), ""),
                     F.element_at(between, -1))
    n = F.size(F.filter(F.zip_with("found", "new", lambda a, b: a != b), lambda x: x))
    return changed.select("row", F.when(F.size("found") > 0, whole).otherwise(F.col("t")).alias("text"),
                          F.when(F.col("t").isNull(), F.lit(0)).otherwise(n).alias("n_replaced"))
