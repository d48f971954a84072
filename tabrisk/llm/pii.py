"""Format-preserving pseudonyms for personal data, in DataFrame expressions only.

Found values are validated (Luhn and mod-97 check digits, calendar dates, octet
and area ranges) and then permuted by a keyed Feistel network inside their own
format: a card number becomes another number of that length with a right check
digit, a date another date of its 400-year Gregorian cycle, written the same
way. The permutation depends on the key and the format alone, so equal values
stay equal in every document and different ones stay different; with the key
it can be inverted. (Only a card number among other digit groups may take
another pseudonym than alone, where inverting asks for it: see ``card``.) What
fails validation is left as it is.

| kind | pattern | domain that is permuted |
|---|---|---|
| email | local@domain.tld | letters and digits of the local part, each within its own class |
| card | 13-19 digits, single blanks or hyphens between; whole groups of a run of any length | all but the check digit, which follows from them |
| iban | country, 2 check digits, 11-30 letters or digits | digits of the account part; check digits follow |
| ssn | ddd-dd-dddd with valid area, group and serial | the valid numbers |
| phone | +c (ddd) ddd-dddd and kin, ddd-ddd-dddd | all digits after the country code |
| ip | four octets | 32 bits |
| date | y-m-d, y/m/d, d/m/y, m/d/y, d.m.y, d-m-y | days of the 400-year cycle |

A slashed date is day first when that is a date, month first otherwise (those
are cycle-walked so that they stay so). Rounds: ``ROUNDS``; round function:
SHA-256 of key, format, round and the other half.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
DEFAULT_KEY = "replace-this-key"
_IP = r"(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![\p{L}\p{N}]|\.[0-9])"
#: A blank and a whole value of another kind: there a phone number or a run of digits ends.
_OTHER = (
    rf" (?:{_IP}|[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![\p{{L}}\p{{N}}]|-[0-9])|[0-9]{{3}}(?:-[0-9]{{3}}-|\.[0-9]{{3}}\.)[0-9]{{4}}(?![\p{{L}}\p{{N}}])"
    r"|(?:[0-9]{4}(?:-[0-9]{2}-|/[0-9]{2}/)[0-9]{2}|[0-9]{2}(?:-[0-9]{2}-|/[0-9]{2}/|\.[0-9]{2}\.)[0-9]{4})(?![\p{L}\p{N}]|[./-][0-9])"
    r"|[\p{L}\p{N}._%+-]{1,64}+@[A-Za-z0-9-])"
)
_CARD_NEXT = r" [0-9](?:[ -]?[0-9]){12,18}(?![\p{L}\p{N}])"
_GROUP = r"[ .-]?[0-9]{2,4}"
#: Groups of an international number, 9-15 digits in all: kept apart from all that follows, if that leaves a
#: number; else its own groups may look like a card's, and at last like anything.
_GROUPS = "|".join(
    x + r"(?<=\+" + r"[ .()-]{0,2}[0-9]" * 9 + r"(?:[ .()-]{0,2}[0-9])?" * 6 + r")(?![\p{L}\p{N}])"
    for x in (rf"(?:(?!{_OTHER}|{_CARD_NEXT}){_GROUP}){{2,4}}", rf"(?:(?!{_OTHER}){_GROUP}){{2}}(?:(?!{_OTHER}|{_CARD_NEXT}){_GROUP}){{0,2}}", rf"(?:{_GROUP}){{2,4}}")
)
#: Kinds in the order in which they are tried at a place of the text. A run of digit groups ("card") may hold
#: several values and digits that belong to none; ``_pieces`` takes it apart.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+)*\.[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "date": r"(?<![\p{L}\p{N}./-])(?:[0-9]{4}([-/])[0-9]{2}\1[0-9]{2}|[0-9]{2}([-/.])[0-9]{2}\2[0-9]{4})(?![\p{L}\p{N}]|[./-][0-9])",
    "ip": r"(?<![\p{L}\p{N}.])" + _IP,
    "ssn": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}]|-[0-9])",
    "phone": rf"(?<![\p{{L}}\p{{N}}+])(?:\+[0-9]{{1,3}}[ .-]?(?:\([0-9]{{1,4}}\)|[0-9]{{1,4}})(?:{_GROUPS})|\([0-9]{{3}}\) ?[0-9]{{3}}[ .-][0-9]{{4}}|[0-9]{{3}}([ .-])[0-9]{{3}}\3[0-9]{{4}})(?![\p{{L}}\p{{N}}])",
    "card": rf"(?<![\p{{L}}\p{{N}}])(?=[0-9](?:[ -]?[0-9]){{12}})[0-9]++(?![\p{{L}}\p{{N}}])(?:(?!{_OTHER})[ -][0-9]++(?![\p{{L}}\p{{N}}]))*+",
}
ANY = "|".join(PATTERNS.values())


def _num(hexed: Column) -> Column:
    """Up to 15 hex digits as a long."""
    return F.conv(hexed, 16, 10).cast("long")


def _rounds(back: bool) -> Column:
    order = range(ROUNDS)
    return F.array(*[F.lit(i) for i in (reversed(order) if back else order)])


def feistel(a: Column, b: Column, mod_a: Column, mod_b: Column, key: str, tweak: Column, back: bool = False) -> Column:
    """Keyed permutation of pairs (a, b) of longs, 0 <= a < mod_a and 0 <= b < mod_b (moduli up to 10^18): struct(a, b).

    Each round adds the hash of one half to the other, modulo the other's size,
    and swaps them; an even number of rounds puts the halves back in place.
    ``back`` inverts it.
    """

    def step(x: Column, i: Column) -> Column:
        left, right = x["a"], x["b"]
        moved, other = (right, left) if back else (left, right)
        mod = F.when(i % 2 == 0, x["ma"]).otherwise(x["mb"])
        f = F.pmod(_num(F.substring(F.sha2(F.concat_ws(":", F.lit(key), x["t"], i.cast("string"), other.cast("string")).cast("binary"), 256), 1, 15)), mod)
        new = F.pmod(moved - f if back else moved + f, mod)
        return F.struct((new if back else right).alias("a"), (left if back else new).alias("b"), x["ma"].alias("ma"), x["mb"].alias("mb"), x["t"].alias("t"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"), mod_a.cast("long").alias("ma"), mod_b.cast("long").alias("mb"), tweak.alias("t"))
    return F.aggregate(_rounds(back), start, step, lambda x: F.struct(x["a"], x["b"]))


def _pow10(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def feistel_digits(digits: Column, key: str, tweak: str, back: bool = False) -> Column:
    """A string of 2 to 36 digits to another of that length."""

    def work(d: Column) -> Column:
        n = F.length(d)
        u = F.floor(n / 2).cast("int")
        v = n - u
        x = feistel(d.substr(F.lit(1), u), d.substr(u + 1, v), _pow10(u), _pow10(v), key, F.concat(F.lit(tweak), n.cast("string")), back)
        return F.concat(F.lpad(x["a"].cast("string"), u, "0"), F.lpad(x["b"].cast("string"), v, "0"))

    return _let(digits, work)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _fill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by ``digits``, in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"), digits.alias("d"))

    def step(x: Column, ch: Column) -> Column:
        is_digit = ch.between("0", "9")
        return F.struct(F.concat(x["out"], F.when(is_digit, x["d"].substr(x["k"], F.lit(1))).otherwise(ch)).alias("out"), (x["k"] + is_digit.cast("int")).alias("k"), x["d"].alias("d"))

    return F.aggregate(F.split(shape, ""), start, step, lambda x: x["out"])


def _luhn_sum(digits: Column, double_last: bool) -> Column:
    """Luhn sum; ``double_last`` when the check digit is still to come."""
    rev = F.split(F.reverse(digits), "")
    odd = 0 if double_last else 1

    def term(ch: Column, i: Column) -> Column:
        d = ch.cast("int")
        return F.when(i % 2 == odd, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.transform(rev, term), F.lit(0), lambda x, y: x + y)


def _card(m: Column, key: str, back: bool = False) -> Column:
    """A Luhn-valid number to another with the same length and separators."""

    def work(d: Column) -> Column:
        body = feistel_digits(d.substr(F.lit(1), F.length(d) - 1), key, "card", back)
        return _let(body, lambda x: F.concat(x, F.pmod(-_luhn_sum(x, True), F.lit(10)).cast("string")))

    return _fill(m, _let(_digits(m), work))


#: Groups of a run whose pieces are gathered at a time.
CHUNK = 64


def _pieces(run: Column) -> Column:
    """A run of digit groups as pieces (v: the text with its leading separator, k: the kind or "").

    From left to right, a piece is the longest card number that begins with the
    group (whole groups, 13-19 digits, Luhn), else a phone number of 3, 3 and 4
    digits, else the group alone. The pieces of ``CHUNK`` groups are gathered at
    a time, so that long runs do not copy all pieces at each group.
    """

    def work(g: Column) -> Column:
        def take(i: Column, n: Column) -> Column:
            return F.array_join(F.slice(g, i, n), "")

        def is_card(i: Column, n: Column) -> Column:
            return _let(_digits(take(i, n)), lambda d: F.length(d).between(13, 19) & (_luhn_sum(d, False) % 10 == 0))

        def step(x: Column, i: Column) -> Column:
            cards = F.filter(F.sequence(F.least(F.lit(19), F.size(g) - i + 1), F.lit(1), F.lit(-1)), lambda n: is_card(i, n))
            phone_here = take(i, F.lit(3)).rlike(r"^[ -]?[0-9]{3}([ -])[0-9]{3}\1[0-9]{4}$")
            n = F.coalesce(F.get(cards, F.lit(0)), F.when(phone_here, 3).otherwise(1))
            kind = F.when(F.size(cards) > 0, "card").when(phone_here, "phone").otherwise("")
            new = _let(F.struct(n.alias("n"), kind.alias("k")), lambda y: F.struct((i + y["n"]).alias("at"), F.concat(x["p"], F.array(F.struct(take(i, y["n"]).alias("v"), y["k"].alias("k")))).alias("p")))
            return F.when(i < x["at"], x).otherwise(new)

        def chunk(x: Column, first: Column) -> Column:
            places = F.sequence(first, F.least(first + (CHUNK - 1), F.size(g)))
            start = F.struct(x["at"].alias("at"), F.array().cast("array<struct<v:string,k:string>>").alias("p"))
            return _let(F.aggregate(places, start, step), lambda y: F.struct(y["at"].alias("at"), F.concat(x["p"], F.array(y["p"])).alias("p")))

        start = F.struct(F.lit(1).alias("at"), F.array().cast("array<array<struct<v:string,k:string>>>").alias("p"))
        return F.flatten(F.aggregate(F.sequence(F.lit(1), F.size(g), F.lit(CHUNK)), start, chunk, lambda x: x["p"]))

    return _let(F.split(run, "(?<=[0-9])(?=[ -])"), work)


#: Bound of the steps until a run falls apart as before (one is enough for nearly all), and the characters of a
#: run up to which that is asked for: among many numbers one nearly always gives other pieces by chance.
WALK = 400
WALKED = 200


def card(m: Column, key: str, back: bool = False) -> Column:
    """A run of digit groups with its card and phone numbers permuted; digits that belong to none stay.

    New digits may by chance give another piece with those around them, so the
    permutation is repeated until the pieces are the same places again: that keeps
    it invertible. A value alone takes one step. In a run of more than ``WALKED``
    characters each value takes its pseudonym in one step, as if alone; inverting
    such a run may read it differently.
    """
    join = lambda p: F.array_join(F.transform(p, lambda y: y["v"]), "")

    def move(y: Column) -> Column:
        return F.struct(F.when(y["k"] == "card", _card(y["v"], key, back)).when(y["k"] == "phone", phone(y["v"], key, back)).otherwise(y["v"]).alias("v"), y["k"].alias("k"))

    def step(x: Column, _: Column) -> Column:
        new = _let(F.transform(x["p"], move), lambda p: F.struct(p.alias("p"), (_pieces(join(p)) == p).alias("done")))
        return F.when(x["done"], x).otherwise(new)

    def work(p: Column) -> Column:
        start = F.struct(p.alias("p"), (~F.exists(p, lambda y: y["k"] != "")).alias("done"))
        steps = F.when(F.length(m) <= WALKED, WALK).otherwise(1)
        return join(F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda x: x["p"]))

    return _let(_pieces(m), work)


def _mod97(s: Column) -> Column:
    """The number that the IBAN rules read from capitals and digits, modulo 97."""

    def step(x: Column, ch: Column) -> Column:
        digit = ch.between("0", "9")
        return F.when(digit, x * 10 + F.ascii(ch) - 48).otherwise(x * 100 + F.ascii(ch) - 55) % 97

    return F.aggregate(F.split(s, ""), F.lit(0), step)


def iban(m: Column, key: str, back: bool = False) -> Column:
    """An IBAN with right check digits to another of its country: account digits permuted, letters and blanks kept."""
    plain = F.regexp_replace(m, " ", "")
    valid = (F.length(plain).between(15, 34)) & (_mod97(F.concat(plain.substr(F.lit(5), F.length(plain)), plain.substr(1, 4))) == 1)
    account = m.substr(F.lit(5), F.length(m))
    digits = _digits(account)

    def done(new: Column) -> Column:
        body = F.regexp_replace(new, " ", "")
        check = F.lit(98) - _mod97(F.concat(body, m.substr(1, 2), F.lit("00")))
        return F.concat(m.substr(1, 2), F.lpad(check.cast("string"), 2, "0"), new)

    return F.when(valid & F.length(digits).between(2, 36), _let(_fill(account, feistel_digits(digits, key, "iban", back)), done)).otherwise(m)


def ssn(m: Column, key: str, back: bool = False) -> Column:
    """A number with area 001-899 but 666, group 01-99 and serial 0001-9999 to another such number."""
    area, group, serial = (F.substring(m, *x).cast("int") for x in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)

    def done(x: Column) -> Column:
        p = F.floor(x["a"] / 99)
        return F.concat_ws("-", *(F.lpad(v.cast("string"), n, "0") for v, n in ((F.when(p >= 665, p + 2).otherwise(p + 1), 3), (x["a"] % 99 + 1, 2), (x["b"] + 1, 4))))

    return F.when(valid, _let(feistel(place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, F.lit("ssn"), back), done)).otherwise(m)


def phone(m: Column, key: str, back: bool = False) -> Column:
    """All digits after the country code (up to the first separator; one digit if there is none) of numbers with 9 to 15 digits."""
    code = F.when(m.startswith("+"), F.when(m.rlike(r"^\+[0-9]{1,3}[ .(-]"), F.regexp_extract(m, r"^(\+[0-9]{1,3})", 1)).otherwise(m.substr(1, 2))).otherwise(F.lit(""))

    def done(c: Column) -> Column:
        rest = m.substr(F.length(c) + 1, F.length(m))
        return F.concat(c, _fill(rest, feistel_digits(_digits(rest), key, "phone", back)))

    return F.when(F.length(_digits(m)).between(9, 15), _let(code, done)).otherwise(m)


def ip(m: Column, key: str, back: bool = False) -> Column:
    """Four octets to four octets."""

    def done(x: Column) -> Column:
        return F.concat_ws(".", *(v.cast("string") for h in ("a", "b") for v in (F.floor(x[h] / 256), x[h] % 256)))

    def work(o: Column) -> Column:
        n = [F.element_at(o, i).cast("int") for i in range(1, 5)]
        return _let(feistel(n[0] * 256 + n[1], n[2] * 256 + n[3], F.lit(65536), F.lit(65536), key, F.lit("ip"), back), done)

    return _let(F.split(m, r"\."), work)


#: Days in 400 Gregorian years, as two factors for the halves of the network (fixed values).
CYCLE_A, CYCLE_B = 189, 773


def _is_date(y: Column, m: Column, d: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    last = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    return (y >= 1) & m.between(1, 12) & (d >= 1) & (d <= last)


def _day_number(y: Column, m: Column, d: Column) -> Column:
    """Days since 0000-03-01 of the proleptic Gregorian calendar."""
    yy = F.when(m > 2, y).otherwise(y - 1)
    return yy * 365 + F.floor(yy / 4) - F.floor(yy / 100) + F.floor(yy / 400) + F.floor((((m + 9) % 12) * 153 + 2) / 5) + d - 1


def _date_of(n: Column) -> Column:
    """struct(y, m, d) of a day number; one date has each number."""
    return _let(F.date_add(F.lit("0000-03-01").cast("date"), n.cast("int")), lambda t: F.struct(F.year(t).alias("y"), F.month(t).alias("m"), F.dayofmonth(t).alias("d")))


def _permute_day(n: Column, key: str, tweak: str, back: bool) -> Column:
    """A day number to another of its 400-year cycle (cycles begin on the first of March of years that 400 divides)."""
    size = CYCLE_A * CYCLE_B

    def work(v: Column) -> Column:
        x = feistel(F.floor(v % size / CYCLE_B), v % size % CYCLE_B, F.lit(CYCLE_A), F.lit(CYCLE_B), key, F.lit(tweak), back)
        return _let(x, lambda r: F.floor(v / size) * size + r["a"] * CYCLE_B + r["b"])

    return _let(n.cast("long"), work)


def date(m: Column, key: str, back: bool = False) -> Column:
    """A calendar date from 0400-03-01 to 9600-02-29 to another, in the same notation."""

    def work(p: Column) -> Column:
        e = [F.element_at(p, i) for i in (1, 2, 3)]
        n = [x.cast("int") for x in e]
        sep = m.substr(F.when(F.length(e[0]) == 4, 5).otherwise(3), F.lit(1))
        write = lambda *x: F.concat_ws("", x[0], sep, x[1], sep, x[2])
        pad = lambda v, k: F.lpad(v.cast("string"), k, "0")
        span = lambda y, mo, d: _day_number(y, mo, d).between(CYCLE_A * CYCLE_B, 24 * CYCLE_A * CYCLE_B - 1)

        def moved(y, mo, d, tweak, form, walk=False):
            start = _day_number(y, mo, d)
            if not walk:
                return _let(_date_of(_permute_day(start, key, tweak, back)), form)
            # month-first dates have a day over 12: step until that holds again (each step fails with odds of 0.4)
            first = F.struct(start.cast("long").alias("n"), F.lit(False).alias("done"))

            def step(x: Column, _: Column) -> Column:
                new = _let(_permute_day(x["n"], key, tweak, back), lambda v: F.struct(v.alias("n"), (_date_of(v)["d"] > 12).alias("done")))
                return F.when(x["done"], x).otherwise(new)

            return _let(_date_of(F.aggregate(F.sequence(F.lit(1), F.lit(48)), first, step)["n"]), form)

        iso = (F.length(e[0]) == 4) & _is_date(n[0], n[1], n[2]) & span(n[0], n[1], n[2])
        day_first = (F.length(e[0]) == 2) & _is_date(n[2], n[1], n[0]) & span(n[2], n[1], n[0])
        month_first = (F.length(e[0]) == 2) & _is_date(n[2], n[0], n[1]) & span(n[2], n[0], n[1])
        return (
            F.when(iso, moved(n[0], n[1], n[2], "ymd", lambda t: write(pad(t["y"], 4), pad(t["m"], 2), pad(t["d"], 2))))
            .when(day_first, moved(n[2], n[1], n[0], "dmy", lambda t: write(pad(t["d"], 2), pad(t["m"], 2), pad(t["y"], 4))))
            .when(month_first, moved(n[2], n[0], n[1], "mdy", lambda t: write(pad(t["m"], 2), pad(t["d"], 2), pad(t["y"], 4)), walk=True))
            .otherwise(m)
        )

    return _let(F.split(m, "[-/.]"), work)


def email(m: Column, key: str, back: bool = False) -> Column:
    """The local part's ASCII letters and digits, each to one of its own class (lower, upper, digit); the domain stays.

    The halves are strings; a round adds the hash of one to the other, letter by
    letter. A single letter is shifted by a keyed amount.
    """

    def shift(target: Column, other: Column, tag: Column) -> Column:
        stream = F.sha2(F.concat_ws(":", F.lit(key), F.lit("email"), tag, other).cast("binary"), 512)

        def one(ch: Column, i: Column) -> Column:
            f = F.conv(F.substring(stream, 1, 128).substr(i * 2 + 1, F.lit(2)), 16, 10).cast("int") * (-1 if back else 1)
            low = F.when(ch.between("0", "9"), 48).when(ch.between("a", "z"), 97).otherwise(65)
            size = F.when(low == 48, 10).otherwise(26)
            return F.char(low + F.pmod(F.ascii(ch) - low + f, size))

        return F.when(F.length(target) == 0, target).otherwise(F.array_join(F.transform(F.split(target, ""), one), ""))

    def step(x: Column, i: Column) -> Column:
        tag = F.concat_ws("/", i.cast("string"), x["n"].cast("string"))
        if back:
            return F.struct(shift(x["b"], x["a"], tag).alias("a"), x["a"].alias("b"), x["n"].alias("n"))
        return F.struct(x["b"].alias("a"), shift(x["a"], x["b"], tag).alias("b"), x["n"].alias("n"))

    def permuted(s: Column) -> Column:
        n = F.length(s)
        u = F.floor(n / 2).cast("int")
        start = F.struct(s.substr(F.lit(1), u).alias("a"), s.substr(u + 1, n - u).alias("b"), n.alias("n"))
        halves = F.aggregate(_rounds(back), start, step, lambda x: F.concat(x["a"], x["b"]))
        return F.when(n == 0, s).when(n == 1, shift(s, F.lit(""), F.lit("one"))).otherwise(halves)

    def fill(local: Column) -> Column:
        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"), permuted(F.regexp_replace(local, "[^A-Za-z0-9]", "")).alias("d"))

        def put(x: Column, ch: Column) -> Column:
            own = ch.rlike("[A-Za-z0-9]")
            return F.struct(F.concat(x["out"], F.when(own, x["d"].substr(x["k"], F.lit(1))).otherwise(ch)).alias("out"), (x["k"] + own.cast("int")).alias("k"), x["d"].alias("d"))

        return F.aggregate(F.split(local, ""), start, put, lambda x: x["out"])

    at = F.instr(m, "@")
    return F.concat(fill(m.substr(F.lit(1), at - 1)), m.substr(at, F.length(m)))


_BY_KIND = {"email": email, "iban": iban, "date": date, "ip": ip, "ssn": ssn, "phone": phone, "card": card}


def kind_of(m: Column) -> Column:
    """Which pattern a found value has (the first that fits all of it)."""
    out = F.when(m.contains("@"), "email")
    for kind, p in list(PATTERNS.items())[1:]:
        out = out.when(m.rlike(f"^(?:{_alone(kind)})$"), kind)
    return out


def _alone(kind: str) -> str:
    """A kind's pattern with its own group numbers (in ``ANY`` they count on)."""
    number = {"date": {r"\1": r"\1", r"\2": r"\2"}, "phone": {r"\3": r"\1"}}.get(kind, {})
    p = PATTERNS[kind]
    for a, b in number.items():
        p = p.replace(a, b)
    return p


def pseudonym(m: Column, key: str = DEFAULT_KEY, back: bool = False) -> Column:
    """The pseudonym of a found value; values that fail their kind's validation stay. ``back`` gives the value of a pseudonym."""
    kind = kind_of(m)
    return _let(F.struct(m.alias("m"), kind.alias("k")), lambda x: _by_kind(x, key, back))


def _by_kind(x: Column, key: str, back: bool) -> Column:
    out = None
    for kind, fn in _BY_KIND.items():
        out = F.when(x["k"] == kind, fn(x["m"], key, back)) if out is None else out.when(x["k"] == kind, fn(x["m"], key, back))
    return out.otherwise(x["m"])


def replace(docs: DataFrame, text: str = "text", key: str = DEFAULT_KEY, back: bool = False, count: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text``; all other columns stay, and ``count`` names one more for the number of changed values.

    Null stays null and empty stays empty. No row moves: there is no shuffle.
    Rows may repeat; equal texts give equal results. ``back`` inverts it.
    """
    t = F.col(f"`{text}`")
    some = t.rlike("[0-9@]")
    parts = F.split(t, ANY, -1)
    found = F.regexp_extract_all(t, F.lit(ANY), F.lit(0))
    n_of = lambda x: F.when(x["k"] == "card", F.size(F.filter(_pieces(x["m"]), lambda y: y["k"] != ""))).otherwise(1)
    hit = lambda m: _let(F.struct(m.alias("m"), kind_of(m).alias("k")), lambda x: F.struct(x["m"].alias("old"), _by_kind(x, key, back).alias("new"), n_of(x).alias("n")))
    both = F.arrays_zip(parts.alias("part"), F.concat(F.transform(found, hit), F.array(F.struct(F.lit("").alias("old"), F.lit("").alias("new"), F.lit(0).alias("n")))).alias("hit"))
    done = docs.withColumn("_pii_parts_", F.when(some, both))
    joined = F.array_join(F.transform(F.col("_pii_parts_"), lambda x: F.concat(x["part"], x["hit"]["new"])), "")
    changed = F.aggregate(F.filter(F.col("_pii_parts_"), lambda x: x["hit"]["old"] != x["hit"]["new"]), F.lit(0), lambda n, x: n + x["hit"]["n"])
    cols = [F.when(F.col("_pii_parts_").isNotNull(), joined).otherwise(t).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return done.select(*cols, *([F.when(t.isNull() | ~some, F.lit(0)).otherwise(changed).cast("long").alias(count)] if count else []))
