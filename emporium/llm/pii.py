"""Format-preserving pseudonyms of personal data (native: DataFrame functions only).

Found and validated: payment cards (Luhn), phone numbers (numbering rules), IPv4
addresses, US social security numbers, IBANs (mod 97), calendar dates and e-mail
addresses.  A valid value is replaced by the image of a keyed permutation of the
values of its own format, so the result is again valid and of the same written
form, different values stay different, and equal values get equal pseudonyms in
every document.  Values that do not validate are left as they are.

The permutation is a Feistel network over two unequal halves: numbers L of Z_a and
R of Z_b, or two character strings, are changed in turn by adding a keyed
SHA-256 value of the other half.  Dates are numbered within the 400-year cycle of
the calendar, 146,097 = 189 · 773 days; those written with slashes or without
leading zeros walk on until the image is written the same way.

A text is split at its finds and put together again, in its own row: nothing is
shuffled.  Null texts stay null, empty texts empty; repeated rows are treated alike;
other columns are returned as they are.  Found text is whole: overlapping finds go
to the first in the order of ``KINDS``.  Groups of digits beside each other, and finds
that do not validate, are searched group by group for the kinds that such text can hold.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
DEFAULT_KEY = "set a secret key for real data"

# The written forms, in order of precedence (Java regular expressions).
# Repeated groups have a fixed width, are possessive or bounded: others recurse for each turn.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-](?:(?!\.\.)[A-Za-z0-9.-])*\.[A-Za-z]{2,}",
    "ipv4": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    # All groups of digits that follow each other, if of 13 digits or more: see _groups.
    "card": r"(?<![\d+])(?=\d(?:[ -]?\d){12})\d+(?:[ -]\d+(?![\dA-Za-z/@]|\.\d))*+",
    "phone": r"(?<!\d)(?:(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|\+1[ .-]?\d{10})(?!\d)",
    "phone_e164": r"(?<!\d)\+(?!1)\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,4}(?!\d)",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: How cards are written; what a find that does not validate is searched for.
CARD_FORMS = r"^(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})(?!\d)"
INNER = "|".join(f"(?:{KINDS[k]})" for k in ("ssn", "card", "phone"))
#: A run of groups of digits, and as many of them as any value has and more.
BLOCK = r"(?:\d++[ -]?+){1,64}"
AHEAD = r"^[ -]?(?:\d++[ -]){8}"


def _long(c: Column) -> Column:
    return c.cast("long")


def _digest(key: str, kind: str, turn: Column, value: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|"), turn.cast("string"), F.lit("|"), value.cast("string")), 256)


def _number(digest: Column, at: Column | int = 1, digits: int = 13) -> Column:
    """A number of 4 bits for each hexadecimal digit of the digest."""
    part = F.substr(digest, F.lit(at) if isinstance(at, int) else at, F.lit(digits))
    return _long(F.conv(part, 16, 10))


def _feistel(key: str, kind: str, left: Column, right: Column, a: Column, b: Column) -> Column:
    """The keyed permutation of Z_a x Z_b: struct(l, r)."""

    def turn(s: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.struct(
            F.pmod(s["l"] + _number(_digest(key, kind, i, s["r"])) % a, a).alias("l"), s["r"].alias("r"))
        ).otherwise(F.struct(
            s["l"].alias("l"), F.pmod(s["r"] + _number(_digest(key, kind, i, s["l"])) % b, b).alias("r")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
                       F.struct(_long(left).alias("l"), _long(right).alias("r")), turn)


def _shift(c: Column, by: Column) -> Column:
    """The character ``by`` places on in its class: digits, small or capital letters."""
    code = F.ascii(c)

    def within(first: int, n: int) -> Column:
        return F.char(F.pmod(code - first + by, F.lit(n)) + first)

    return (F.when(code.between(48, 57), within(48, 10)).when(code.between(97, 122), within(97, 26))
            .when(code.between(65, 90), within(65, 26)).otherwise(c))


def _feistel_text(key: str, kind: str, text: Column) -> Column:
    """The keyed permutation of strings of the same character classes."""
    half = F.floor(F.length(text) / 2).cast("int")

    def moved(own: Column, other: Column, turn: Column) -> Column:
        def with_seed(seed: Column) -> Column:
            def one(c: Column, i: Column) -> Column:
                digest = _digest(key, kind, turn, F.concat(seed, F.lit("|"), F.floor(i / 15).cast("string")))
                return _shift(c, _number(digest, (i % 15) * 4 + 1, 4))
            return F.array_join(F.transform(F.filter(F.split(own, ""), lambda c: c != ""), one), "")
        # of the other half as a whole, so that long strings take linear time
        return _let(F.sha2(F.lower(other), 256), with_seed)

    def turn(s: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.struct(moved(s["l"], s["r"], i).alias("l"), s["r"].alias("r"))
                      ).otherwise(F.struct(s["l"].alias("l"), moved(s["r"], s["l"], i).alias("r")))

    s = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
                    F.struct(F.substr(text, F.lit(1), half).alias("l"),
                             F.substr(text, half + 1, F.length(text)).alias("r")), turn)
    return F.concat(s["l"], s["r"])


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _refill(form: Column, chars: Column, keep: str) -> Column:
    """``form`` with its characters of class ``keep`` replaced by those of ``chars`` in turn."""
    def one(c: Column, i: Column) -> Column:
        nth = F.length(F.regexp_replace(F.substr(form, F.lit(1), i + 1), f"[^{keep}]", ""))
        return F.when(c.rlike(f"^[{keep}]$"), F.substr(chars, nth, F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.filter(F.split(form, ""), lambda c: c != ""), one), "")


def _only(text: Column, keep: str) -> Column:
    return F.regexp_replace(text, f"[^{keep}]", "")


def _pad(n: Column, width: Column | int) -> Column:
    return F.lpad(n.cast("string"), F.lit(width) if isinstance(width, int) else width, F.lit("0"))


def _luhn_digit(payload: Column) -> Column:
    """The check digit that makes ``payload`` a valid card number."""
    n = F.length(payload)

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substr(payload, n - i + 1, F.lit(1))) - 48
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
    return F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("string")


def _card(key: str, hit: Column) -> Column:
    def replaced(d: Column) -> Column:
        n = F.length(d)
        body, width = F.substr(d, F.lit(2), n - 2), F.floor((n - 2) / 2).cast("int")

        def scale(w: Column) -> Column:
            return _long(F.round(F.pow(F.lit(10.0), w)))

        low = F.substr(body, width + 1, n)
        image = _feistel(key, "card", F.substr(body, F.lit(1), width), low, scale(width), scale(F.length(low)))
        payload = _let(image, lambda s: F.concat(F.substr(d, F.lit(1), F.lit(1)), _pad(s["l"], width),
                                                 _pad(s["r"], n - 2 - width)))
        valid = _luhn_digit(F.substr(d, F.lit(1), n - 1)) == F.substr(d, n, F.lit(1))
        new = _let(payload, lambda p: F.concat(p, _luhn_digit(p)))
        return F.when(valid, _let(new, lambda x: _refill(hit, x, "0-9")))
    return _let(_only(hit, "0-9"), replaced)


def _phone(key: str, hit: Column) -> Column:
    """North American numbers: valid area and exchange codes begin with 2 to 9.

    Valid numbers are permuted among themselves.  The others are permuted among
    the others if they are written as a phone number, with the country code or
    with brackets; a bare ddd-ddd-dddd of them is none.
    """
    def replaced(d: Column) -> Column:
        national = F.right(d, F.lit(10))
        area, exchange = _long(F.substr(national, F.lit(1), F.lit(3))), _long(F.substr(national, F.lit(4), F.lit(3)))
        line = _long(F.substr(national, F.lit(7), F.lit(4)))
        image = _feistel(key, "phone", area - 200, (exchange - 200) * 10_000 + line, F.lit(800), F.lit(8_000_000))
        new = _let(image, lambda s: F.concat(
            F.substr(d, F.lit(1), F.length(d) - 10), _pad(s["l"] + 200, 3), _pad(s["r"] + 2_000_000, 7)))

        def walk(s: Column, _: Column) -> Column:  # on to the next image that is not valid either
            def step(t: Column) -> Column:
                return F.struct(t["l"].alias("l"), t["r"].alias("r"),
                                ((t["l"] < 20_000) | (t["l"] % 100 * 10 + F.floor(t["r"] / 10_000) < 200)).alias("ok"))
            return F.when(s["ok"], s).otherwise(_let(
                _feistel(key, "phone-other", s["l"], s["r"], F.lit(100_000), F.lit(100_000)), step))

        start = F.struct(_long(F.substr(national, F.lit(1), F.lit(5))).alias("l"),
                         _long(F.substr(national, F.lit(6), F.lit(5))).alias("r"), F.lit(False).alias("ok"))
        other = _let(F.aggregate(F.sequence(F.lit(1), F.lit(96)), start, walk), lambda s: F.when(s["ok"], F.concat(
            F.substr(d, F.lit(1), F.length(d) - 10), _pad(s["l"], 5), _pad(s["r"], 5))))
        return F.when((area >= 200) & (exchange >= 200), _let(new, lambda x: _refill(hit, x, "0-9"))) \
            .when((F.length(d) == 11) | hit.contains("("), _let(other, lambda x: _refill(hit, x, "0-9")))
    return _let(_only(hit, "0-9"), replaced)


def _phone_e164(key: str, hit: Column) -> Column:
    """Other international numbers: the country code and first digits stay, 8 to 15 digits."""
    def replaced(d: Column) -> Column:
        new = F.concat(F.substr(d, F.lit(1), F.lit(3)),
                       _feistel_text(key, "e164", F.substr(d, F.lit(4), F.length(d))))
        return F.when(F.length(d).between(8, 15), _let(new, lambda x: _refill(hit, x, "0-9")))
    return _let(_only(hit, "0-9"), replaced)


def _ipv4(key: str, hit: Column) -> Column:
    def replaced(o: Column) -> Column:
        image = _feistel(key, "ipv4", o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536))
        new = _let(image, lambda s: F.concat_ws(".", F.floor(s["l"] / 256), s["l"] % 256,
                                                F.floor(s["r"] / 256), s["r"] % 256))
        return F.when(F.array_max(o) <= 255, new)
    return _let(F.transform(F.split(hit, r"\."), _long), replaced)


def _ssn(key: str, hit: Column) -> Column:
    def replaced(o: Column) -> Column:
        valid = o[0].between(1, 899) & (o[0] != 666) & (o[1] > 0) & (o[2] > 0)
        image = _feistel(key, "ssn", o[0] - F.when(o[0] > 666, 2).otherwise(1),
                         (o[1] - 1) * 9999 + o[2] - 1, F.lit(898), F.lit(99 * 9999))
        new = _let(image, lambda s: F.concat_ws(
            "-", _pad(s["l"] + F.when(s["l"] >= 665, 2).otherwise(1), 3),
            _pad(F.floor(s["r"] / 9999) + 1, 2), _pad(s["r"] % 9999 + 1, 4)))
        return F.when(valid, new)
    return _let(F.transform(F.split(hit, "-"), _long), replaced)


def _mod97(text: Column) -> Column:
    """Remainder of the number that letters (A = 10 ... Z = 35) and digits write."""
    def add(total: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code <= 57, (total * 10 + code - 48) % 97).otherwise((total * 100 + code - 55) % 97)
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), add)


def _iban(key: str, hit: Column) -> Column:
    def replaced(x: Column) -> Column:
        country, account = F.substr(x, F.lit(1), F.lit(2)), F.substr(x, F.lit(5), F.length(x))
        valid = F.length(x).between(15, 34) & (
            _mod97(F.concat(account, F.substr(x, F.lit(1), F.lit(4)))) == 1)
        new = _let(_feistel_text(key, "iban", account), lambda a: F.concat(
            country, _pad(98 - _mod97(F.concat(a, country, F.lit("00"))), 2), a))
        return F.when(valid, _let(new, lambda y: _refill(hit, y, "A-Z0-9")))
    return _let(_only(hit, "A-Z0-9"), replaced)


def _date(key: str, hit: Column) -> Column:
    """Dates of the years 1600 to 2399.  With slashes, month before day if that is valid."""
    mark = F.regexp_extract(hit, r"[-/.]", 0)

    def replaced(o: Column) -> Column:
        year_first = F.length(F.regexp_extract(hit, r"^\d+", 0)) == 4
        month_first = (mark == "/") & (o[0] <= 12) & (o[1] <= 31)
        year = F.when(year_first, o[0]).otherwise(o[2])
        month = F.when(year_first | ~month_first, o[1]).otherwise(o[0])
        day = F.when(year_first, o[2]).when(month_first, o[1]).otherwise(o[0])
        late = ~year_first & (mark == "/") & ~month_first  # the day can't be a month
        short = F.regexp_extract(hit, r"(?<!\d)\d[/.]", 0) != ""  # written without leading zeros
        # Whether the date is one of its month (null if the fields are out of range).
        in_range = month.between(1, 12) & day.between(1, 31) & year.between(1600, 2399)
        value = F.when(in_range, F.try_to_date(F.concat_ws("-", _pad(year, 4), _pad(month, 2), _pad(day, 2)),
                                               "yyyy-MM-dd"))
        base = F.lit("1600-01-01").cast("date")

        def step(n: Column) -> Column:
            within, cycle = n % 146_097, F.floor(n / 146_097)
            image = _feistel(key, "date", F.floor(within / 773), within % 773, F.lit(189), F.lit(773))
            return _let(image, lambda s: cycle * 146_097 + s["l"] * 773 + s["r"])

        def fits(n: Column) -> Column:
            d = F.date_add(base, n.cast("int"))
            return ((~late | (F.dayofmonth(d) > 12))
                    & (~short | (F.dayofmonth(d) < 10) | (F.month(d) < 10)))

        def walk(s: Column, _: Column) -> Column:  # on to the next image that is written alike
            return F.when(s["ok"], s).otherwise(_let(step(s["n"]), lambda n: F.struct(
                _long(n).alias("n"), fits(n).alias("ok"))))

        start = F.struct(_long(F.datediff(value, base)).alias("n"), F.lit(False).alias("ok"))
        end = F.aggregate(F.sequence(F.lit(1), F.lit(96)), start, walk)

        def written(s: Column) -> Column:
            d = F.date_add(base, s["n"].cast("int"))
            dd, mm = F.dayofmonth(d), F.month(d)
            dd = F.when(short, dd.cast("string")).otherwise(_pad(dd, 2))
            mm = F.when(short, mm.cast("string")).otherwise(_pad(mm, 2))
            yy = _pad(F.year(d), 4)
            return (F.when(~s["ok"], hit).when(year_first, F.concat_ws(mark_text, yy, mm, dd))
                    .when(month_first, F.concat(mm, mark, dd, mark, yy)).otherwise(F.concat(dd, mark, mm, mark, yy)))

        mark_text = "\u0000"
        return F.when(value.isNotNull(), F.replace(_let(end, written), F.lit(mark_text), mark))
    return _let(F.transform(F.split(hit, r"[-/.]"), _long), replaced)


def _email(key: str, hit: Column) -> Column:
    name = F.substring_index(hit, "@", 1)
    return F.concat(_feistel_text(key, "email", name), F.substr(hit, F.length(name) + 1, F.length(hit)))


def _groups(key: str, hit: Column) -> Column:
    """Groups of digits, joined by single blanks or hyphens: struct(text, n).

    Written throughout with one separator and valid as a whole, they are a card.
    Else the values that begin at a group are replaced from the left, and if
    there is none, the whole as a card if it is valid.
    """
    def found(rest: Column, after: Column) -> Column:
        """struct(len, new) of the value at the start of ``rest``, or null."""
        card = F.regexp_extract(rest, CARD_FORMS, 0)
        phone = F.regexp_extract(rest, "^(?:" + KINDS["phone"] + ")", 0)
        apart = after != "-"
        ssn = F.when(apart, F.regexp_extract(rest, "^(?:" + KINDS["ssn"] + ")", 0)).otherwise("")
        date = F.when(apart, F.regexp_extract(rest, "^(?:" + KINDS["date"] + ")", 0)).otherwise("")

        def image(text: Column, replace: Callable) -> Column:
            return F.when(text != "", _let(text, lambda x: _let(replace(key, x), lambda new: F.when(
                new.isNotNull(), F.struct(F.length(x).alias("len"), new.alias("new"))))))
        return F.coalesce(image(card, _card), image(date, _date), image(ssn, _ssn), image(phone, _phone))

    def step(s: Column, final: Column) -> Column:
        group = F.regexp_extract(s["rest"], r"^\d*[ -]?", 0)
        waits = ~final & ~s["rest"].rlike(AHEAD)  # a value may run on into the next block
        return F.when((s["rest"] == "") | waits, s).otherwise(
            _let(found(s["rest"], s["after"]), lambda f: _let(F.coalesce(f["new"], group), lambda new: F.struct(
                F.concat(s["text"], new).alias("text"),
                (s["n"] + F.when(f.isNotNull(), 1).otherwise(0)).alias("n"),
                F.substr(s["rest"], F.coalesce(f["len"], F.length(group)) + 1, F.length(s["rest"])).alias("rest"),
                F.right(new, F.lit(1)).alias("after")))))

    def block(s: Column, b: Column) -> Column:
        def scan(rest: Column) -> Column:
            # A value ends before a separator, which then is a step of its own.
            start = F.struct(F.lit("").alias("text"), s["n"].alias("n"), rest.alias("rest"), s["after"].alias("after"))
            return F.aggregate(F.sequence(F.lit(1), F.size(F.split(rest, "[ -]")) * 2), start,
                               lambda x, _: step(x, b == ""))
        return _let(_let(F.concat(s["rest"], b), scan), lambda x: F.struct(
            F.concat(s["parts"], F.array(x["text"])).alias("parts"), x["n"].alias("n"), x["rest"].alias("rest"),
            x["after"].alias("after")))

    # Block by block of groups, the end marked by an empty one: the time is linear in the text.
    blocks = F.concat(F.regexp_extract_all(hit, F.lit(BLOCK), F.lit(0)), F.array(F.lit("")))
    scanned = F.aggregate(blocks, F.struct(F.array(F.lit("")).cast("array<string>").alias("parts"), F.lit(0).alias("n"),
                                           F.lit("").alias("rest"), F.lit("").alias("after")), block)
    digits = F.length(_only(hit, "0-9"))
    whole = F.when(digits.between(13, 19), _card(key, hit))
    one = hit.rlike(r"^\d+(?:([ -])\d+(?:\1\d+)*)?$")

    def card(new: Column) -> Column:
        return F.struct(new.alias("text"), F.lit(1).alias("n"))

    def chosen(w: Column) -> Column:
        return F.when(w.isNotNull() & one, card(w)).otherwise(_let(scanned, lambda s: F.when(
            (s["n"] == 0) & w.isNotNull(), card(w)).otherwise(
                F.struct(F.array_join(s["parts"], "").alias("text"), s["n"].alias("n")))))
    return _let(whole, chosen)


_REPLACE = {"email": _email, "ipv4": _ipv4, "date": _date, "ssn": _ssn, "iban": _iban,
            "phone": _phone, "phone_e164": _phone_e164}


def _again(key: str, hit: Column) -> Column:
    """Groups of digits, or a find that does not validate, searched for values: struct(text, n)."""
    def one(x: Column) -> Column:
        def struct(new: Column) -> Column:
            return F.struct(F.coalesce(new, x).alias("text"), (new.isNotNull() & (new != x)).cast("int").alias("n"))
        return F.when(x.rlike(f"^(?:{KINDS['ssn']})$"), struct(_ssn(key, x))) \
            .when(x.rlike(f"^(?:{KINDS['phone']})$"), struct(_phone(key, x))).otherwise(_groups(key, x))

    lead = F.regexp_extract(hit, r"^\+?", 0)
    text = F.substr(hit, F.length(lead) + 1, F.length(hit))

    def joined(news: Column) -> Column:
        parts = F.zip_with(F.split(text, INNER, -1), news["text"], lambda p, n: F.array(p, F.coalesce(n, F.lit(""))))
        return F.struct(F.concat(lead, F.array_join(F.flatten(parts), "")).alias("text"),
                        F.aggregate(news["n"], F.lit(0), lambda t, n: t + n).alias("n"))
    return _let(F.transform(F.regexp_extract_all(text, F.lit(INNER), F.lit(0)), one), joined)


def _replaced(hit: Column, key: str) -> Column:
    """struct(text, n): a find with its n values replaced."""
    new = None
    for kind, replace in _REPLACE.items():
        test = hit.rlike(f"^(?:{KINDS[kind]})$")
        new = F.when(test, replace(key, hit)) if new is None else new.when(test, replace(key, hit))
    return _let(new, lambda x: F.when(x.isNotNull(), F.struct(
        x.alias("text"), (x != hit).cast("int").alias("n"))).otherwise(_again(key, hit)))


def pseudonym(hit: Column, key: str = DEFAULT_KEY) -> Column:
    """The pseudonym of a found value; the value itself if it does not validate."""
    return _replaced(hit, key)["text"]


def pseudonymise(docs: DataFrame, key: str = DEFAULT_KEY, text_col: str = "text",
                 count_col: str | None = None) -> DataFrame:
    """``docs`` with the values in ``text_col`` replaced; other columns as they are.

    ``count_col`` names a column for the number of values replaced in the row.
    """
    taken = {c.lower() for c in [*docs.columns, count_col or ""]}
    found, new = (next(n for n in (f"{name}_{i}" for i in range(len(taken) + 1)) if n not in taken)
                  for name in ("pii_found", "pii_new"))
    text = F.col(text_col)
    hits = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    news = F.transform(found, lambda h: _replaced(h, key))
    parts = F.split(text, PATTERN, -1)
    joined = F.array_join(F.flatten(F.zip_with(
        parts, F.col(f"{new}.text"), lambda p, n: F.array(p, F.coalesce(n, F.lit(""))))), "")
    out = docs.withColumn(found, hits).withColumn(new, F.when(F.size(found) > 0, news))
    if count_col is not None:
        changed = F.aggregate(f"{new}.n", F.lit(0), lambda t, n: t + n)
        out = out.withColumn(count_col, F.when(F.col(new).isNotNull(), changed).otherwise(0))
    return out.withColumn(text_col, F.when(F.col(new).isNotNull(), joined).otherwise(text)).drop(found, new)
