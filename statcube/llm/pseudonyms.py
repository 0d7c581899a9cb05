"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Numbers and dates that pass their validation are permuted by a keyed Feistel network inside the set of
their format: a card number becomes another valid card number of the same length and separators, a date
another date written the same way.  A permutation maps equal values to equal pseudonyms and different
ones to different pseudonyms, so values stay linked across documents without a table of them.

The halves of a value live in two residue rings whose sizes multiply to the size of the format, so no
value leaves the format and no second try is needed.  Each round adds a keyed digest of one half to
the other.  Addresses and secrets, which are no numbers, get a keyed digest in their form.

Defined cases: a null text stays null; what fails its validation stays as it is; rows that repeat give
equal rows; other columns pass through, and the added ones replace columns of their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 10
# The session setting that names the key; without it the key below is used, which anyone can read.
KEY_SETTING = "spark.statcube.pseudonyms.key"
DEFAULT_KEY = "change-me"

KINDS = ("email", "secret", "ip", "date", "phone", "ssn", "card")

# Days from 1900-01-01 to 2099-12-31 are 17 * 4297.
FIRST_DAY = "1900-01-01"
DAY_RINGS = (17, 4297)

_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+"
_NAMED = r"(?i:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_-]{8,}[\"']?"
_ACCESS_KEY = r"(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
_IP = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![0-9]|\.[0-9])"
_ISO = r"\d{4}-\d{2}-\d{2}(?![0-9-])"
_DMY = r"\d{1,2}(?<ds>[./])\d{1,2}\k<ds>\d{4}(?![0-9])"
_PHONE = r"\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}(?![0-9])|\(\d{3}\) ?\d{3}-\d{4}(?![0-9])|\d{3}[.-]\d{3}[.-]\d{4}(?![0-9])"
_SSN = r"\d{3}-\d{2}-\d{4}(?![0-9-])"
_CARD = r"(?:\d{13,19}|\d{4}(?<cs>[ -])\d{4}\k<cs>\d{4}\k<cs>\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![0-9])"
PATTERN = rf"(?<![A-Za-z0-9._%+-])(?:{_EMAIL})|(?<![A-Za-z0-9])(?:{_NAMED}|{_ACCESS_KEY})|(?<![0-9.+-])(?:{_IP}|{_ISO}|{_DMY}|{_PHONE}|{_SSN}|{_CARD})"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _keyed(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *parts), 256)


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, kind: Column) -> Column:
    """A keyed permutation of Z_a x Z_b as a struct of l and r."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def step(state: Column, i: Column) -> Column:
        half = F.when(i % 2 == 0, state["r"]).otherwise(state["l"])
        shift = F.conv(F.substring(_keyed(key, kind, i.cast("string"), half.cast("string")), 1, 15), 16, 10).cast("long")
        return F.struct(
            F.when(i % 2 == 0, (state["l"] + shift % a) % a).otherwise(state["l"]).alias("l"),
            F.when(i % 2 == 0, state["r"]).otherwise((state["r"] + shift % b) % b).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def permuted_digits(digits: Column, key: str, kind: Column) -> Column:
    """Another string of digits of the same length (1 to 34)."""

    def spread(d: Column) -> Column:
        n = F.length(d)
        u = F.floor(n / 2).cast("int")
        left = F.coalesce(F.when(u > 0, F.substring(d, F.lit(1), u)), F.lit("0"))
        state = F.array(feistel(left, F.substring(d, u + 1, n - u), _power(u), _power(n - u), key, F.concat(kind, n.cast("string"))))
        padded = F.transform(state, lambda s: F.concat(
            F.when(u > 0, F.lpad(s["l"].cast("string"), u, "0")).otherwise(""), F.lpad(s["r"].cast("string"), n - u, "0")))
        return F.get(padded, F.lit(0))

    return F.get(F.transform(F.array(digits), spread), F.lit(0))


def _refilled(form: Column, digits: Column) -> Column:
    """The form with its digits replaced in order; everything else stays."""
    return F.get(F.transform(F.array(F.struct(form.alias("f"), digits.alias("d"))), lambda s: F.array_join(
        F.transform(F.sequence(F.lit(1), F.length(s["f"])), lambda i: F.when(
            F.substring(s["f"], i, F.lit(1)).rlike("[0-9]"),
            F.substring(s["d"], F.length(_digits(F.substring(s["f"], F.lit(1), i))), F.lit(1)),
        ).otherwise(F.substring(s["f"], i, F.lit(1)))), "")), F.lit(0))


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits with every second one from the right but the last doubled."""

    def weight(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when((F.length(digits) - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), weight), F.lit(0), lambda s, x: s + x)


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    body = F.concat(F.substring(d, 1, 1), permuted_digits(F.substring(d, F.lit(2), F.length(d) - 2), key, F.lit("card")))
    check = F.transform(F.array(body), lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
    return _refilled(m, F.get(check, F.lit(0)))


def _phone(m: Column, key: str) -> Column:
    """The last ten digits (or all but the country code) move; a leading digit of a three-digit group stays."""
    d = _digits(m)
    n = F.length(d)
    national = F.when(m.startswith("+") & (n < 11), n - F.length(F.regexp_extract(m, r"^\+(\d{1,3})", 1))).otherwise(F.least(n, F.lit(10)))
    code, own = F.substring(d, F.lit(1), n - national), F.substring(d, n - national + 1, national)
    ten = F.concat(F.substring(own, 2, 2), F.substring(own, 5, 6))
    moved = F.when(national == 10, F.get(F.transform(F.array(permuted_digits(ten, key, F.lit("phone"))), lambda p: F.concat(
        F.substring(own, 1, 1), F.substring(p, 1, 2), F.substring(own, 4, 1), F.substring(p, 3, 6))), F.lit(0))
    ).otherwise(permuted_digits(own, key, F.lit("phone")))
    return _refilled(m, F.concat(code, moved))


def _ssn(m: Column, key: str) -> Column:
    d = _digits(m)
    # The area keeps its first digit; areas 000 and 666, group 00 and serial 0000 are left out of the rings.
    first, rest = F.substring(d, 1, 1), F.substring(d, 2, 2).cast("long")
    left_out = F.when(first == "0", 0).when(first == "6", 66)
    areas = F.when(left_out.isNull(), 100).otherwise(99)
    place = rest - F.when(rest > left_out, 1).otherwise(0)
    group, serial = F.substring(d, 4, 2).cast("long") - 1, F.substring(d, 6, 4).cast("long") - 1
    state = F.array(feistel(place * 99 + group, serial, areas * 99, F.lit(9999), key, F.concat(F.lit("ssn"), first)))

    def area(s: Column) -> Column:
        found = F.floor(s["l"] / 99)
        return F.lpad((found + F.when(found >= left_out, 1).otherwise(0)).cast("string"), 2, "0")

    moved = F.transform(state, lambda s: F.concat(
        first, area(s),
        F.lpad((s["l"] % 99 + 1).cast("string"), 2, "0"), F.lpad((s["r"] + 1).cast("string"), 4, "0")))
    return _refilled(m, F.get(moved, F.lit(0)))


def _ip(m: Column, key: str) -> Column:
    """Another address; first parts 0 and 127 are left out of the ring."""
    o = F.split(m, r"\.")
    first = F.get(o, F.lit(0)).cast("long")
    state = F.array(feistel(
        (first - F.when(first > 127, 2).otherwise(1)) * 256 + F.get(o, F.lit(1)).cast("long"),
        F.get(o, F.lit(2)).cast("long") * 256 + F.get(o, F.lit(3)).cast("long"), F.lit(254 * 256), F.lit(65536), key, F.lit("ip")))

    def begin(s: Column) -> Column:
        place = F.floor(s["l"] / 256)
        return place + F.when(place >= 126, 2).otherwise(1)

    return F.get(F.transform(state, lambda s: F.concat_ws(
        ".", begin(s), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256)), F.lit(0))


def _date_parts(m: Column) -> Column:
    """Order and day of a written date; day first unless only month first is a date."""

    def day(y: Column, month: Column, d: Column) -> Column:
        return F.concat(y, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(d, 2, "0")).try_cast("date")

    p = F.split(m, "[-./]")
    x, y, z = (F.get(p, F.lit(i)) for i in range(3))
    return (
        F.when(m.contains("-"), F.struct(F.lit("ymd").alias("order"), day(x, y, z).alias("day")))
        .when(day(z, y, x).isNotNull(), F.struct(F.lit("dmy").alias("order"), day(z, y, x).alias("day")))
        .otherwise(F.struct(F.lit("mdy").alias("order"), day(z, x, y).alias("day"))))


def _date(m: Column, key: str) -> Column:
    """Another day from 1900 to 2099 in the same notation; null for what is no such day."""
    rings = [F.lit(n) for n in DAY_RINGS]

    def moved(w: Column) -> Column:
        number = F.datediff(w["day"], F.lit(FIRST_DAY).cast("date")).cast("long")
        state = feistel(F.floor(number / DAY_RINGS[1]), number % DAY_RINGS[1], *rings, key, F.lit("date"))
        return F.struct(w["order"].alias("order"), F.date_add(F.lit(FIRST_DAY).cast("date"), (state["l"] * DAY_RINGS[1] + state["r"]).cast("int")).alias("day"))

    def written(w: Column) -> Column:
        sign = F.regexp_extract(m, "[-./]", 0)
        # Days and months below 10 are written without a zero where the value was.
        parts = F.split(m, "[-./]")
        bare = (F.length(F.get(parts, F.lit(0))) == 1) | (F.length(F.get(parts, F.lit(1))) == 1)
        y, month, d = F.date_format(w["day"], "yyyy"), *(
            F.when(bare, F.date_format(w["day"], short)).otherwise(F.date_format(w["day"], long)) for short, long in (("M", "MM"), ("d", "dd")))
        return F.when(w["order"] == "ymd", F.concat(y, sign, month, sign, d)).when(
            w["order"] == "dmy", F.concat(d, sign, month, sign, y)).otherwise(F.concat(month, sign, d, sign, y))

    usual = lambda w: w["day"].between(F.lit(FIRST_DAY).cast("date"), F.lit("2099-12-31").cast("date"))
    return F.get(F.transform(F.transform(F.filter(F.array(_date_parts(m)), usual), moved), written), F.lit(0))


def _email(m: Column, key: str) -> Column:
    return F.concat(F.lit("p"), F.substring(_keyed(key, F.lit("email"), F.lower(m)), 1, 12), F.lit("@example.com"))


def _secret(m: Column, key: str) -> Column:
    """The value of a named secret, or an access key behind its prefix, in the same length."""
    named = m.rlike("[=:]")
    before = F.when(named, F.regexp_extract(m, r"""^[^=:]*[=:]\s*["']?""", 0)).otherwise(F.substring(m, 1, 4))
    value = F.when(named, F.regexp_extract(m, r"""^[^=:]*[=:]\s*["']?([A-Za-z0-9+/_-]+)""", 1)).otherwise(F.substring(m, 5, 16))
    digest = F.repeat(_keyed(key, F.lit("secret"), value), 1 + F.floor(F.length(value) / 64).cast("int"))
    new = F.substring(digest, F.lit(1), F.length(value))
    behind = F.substring(m, F.length(before) + F.length(value) + 1, F.length(m))
    return F.concat(before, F.when(named, new).otherwise(F.upper(new)), behind)


def kind_of(m: Column) -> Column:
    """The kind of a match that passes its validation, else null."""
    d = _digits(m)
    octets = F.forall(F.split(m, r"\."), lambda o: F.length(o).between(1, 3) & (o.try_cast("int") <= 255))
    phone = F.length(d).between(8, 15) & F.when(
        (F.length(d) == 10) | d.startswith("1"),
        F.substring(d, F.length(d) - 9, F.lit(1)).between("2", "9") & F.substring(d, F.length(d) - 6, F.lit(1)).between("2", "9")).otherwise(True)
    return (
        F.when(m.contains("@"), "email")
        .when(m.rlike("[A-Za-z]"), "secret")
        .when(m.rlike(r"^\d+(\.\d+){3}$"), F.when(octets & ~m.rlike(r"^(0|127)\."), "ip"))
        .when(m.rlike(r"^\d{4}-\d{2}-\d{2}$|^\d{1,2}[./]\d{1,2}[./]\d{4}$"), F.when(_date(m, "").isNotNull(), "date"))
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.when(~m.rlike(r"^(000|666|9)|-00-|-0000$"), "ssn"))
        .when(m.rlike(r"^[+(]|^\d{3}[.-]\d{3}[.-]\d{4}$"), F.when(phone, "phone"))
        .otherwise(F.when((luhn_sum(d) % 10 == 0) & ~d.rlike("^0+$"), "card")))


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    makers = {"email": _email, "secret": _secret, "ip": _ip, "date": _date, "phone": _phone, "ssn": _ssn, "card": _card}
    value = m
    for name, make in makers.items():
        value = F.when(kind == name, make(m, key)).otherwise(value)
    return value


def pseudonymise(docs: DataFrame, key: str | None = None) -> DataFrame:
    """The documents with pseudonyms in ``text`` and ``found``, an array of (kind, before, after).

    The key is the one given, else that of the session's ``spark.statcube.pseudonyms.key``.
    Texts without a digit, an at sign or an assignment are passed on unread by the long pattern.
    """
    key = key or docs.sparkSession.conf.get(KEY_SETTING, DEFAULT_KEY)
    candidate = F.col("text").rlike("[0-9@=:]")
    matches = F.when(candidate, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = docs.select(F.struct(*[c for c in docs.columns if c not in ("text", "found")]).alias("row"), "text", matches.alias("matches"))
    kinds = rows.withColumn("kinds", F.transform("matches", lambda m: F.struct(m.alias("before"), kind_of(m).alias("kind"))))
    found = kinds.select("row", "text", F.transform("kinds", lambda k: F.struct(
        k["kind"].alias("kind"), k["before"].alias("before"), pseudonym(k["before"], k["kind"], key).alias("after"))).alias("all"))
    pieces = F.split("text", PATTERN, -1)
    joined = F.array_join(F.transform(pieces, lambda s, i: F.concat(s, F.coalesce(F.get("all", i)["after"], F.lit("")))), "")
    # Through a generator, so that no later filter is pushed below and repeats the work.
    done = found.select("row", F.inline(F.array(F.struct(
        F.when(F.size("all") > 0, joined).otherwise(F.col("text")).alias("text"),
        F.filter("all", lambda f: f["kind"].isNotNull()).alias("found")))))
    order = [c if c == "text" else f"row.{c}" for c in docs.columns if c != "found"]
    return done.select(*order, "found")
