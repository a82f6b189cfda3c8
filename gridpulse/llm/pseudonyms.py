"""Format-preserving pseudonyms for personal data, by a keyed Feistel network.

Numbers and dates that pass their validation are permuted inside their own
format: a card number stays a valid card number (Luhn) of the same length
and first digit, a phone number a valid number of the plan, a date a date.
The value is split into two halves x in [0, p) and y in [0, q); every round
replaces (x, y) by (y, (x + F(key, kind, round, y)) mod p), and after an even
number of rounds both halves are in their ranges again.  This is a
permutation of the format, the same for all documents: equal values stay
equal, different values stay different.

Values without a numeric format (mail addresses, credentials) get a keyed
digest of the same make instead, so they too stay linked.

Everything is a projection of built-in SQL functions: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import id_and_text

ROUNDS = 8

# What each kind looks like; the leftmost and then the first kind that fits and is valid counts.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "credential": r"(?<![A-Za-z])(?i:password|passwd|secret|token|api_key|apikey) ?[=:] ?\"?[A-Za-z0-9+/_-]{8,}\"?",
    "access_key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ipv6": r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]{0,4}:)[0-9A-Fa-f:]{6,39}(?![0-9A-Za-z:.])",
    "ipv4": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "date_iso": r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])",
    "date_us": r"(?<![0-9/])[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}(?![0-9/])",
    "date_dot": r"(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+])(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-]?)[2-9][0-9]{2}[ .-]?[0-9]{4}(?![0-9])",
    "phone_abroad": r"(?<![0-9+])\+[2-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,4}\)?){2,6}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
}
# A date with slashes is read month first, and day first where that is no date.
KINDS = {**PATTERNS, "date_dmy": PATTERNS["date_us"]}
ANY = "|".join(PATTERNS.values())
DATE_FORMATS = {"date_iso": "yyyy-MM-dd", "date_us": "M/d/yyyy", "date_dmy": "d/M/yyyy", "date_dot": "dd.MM.yyyy"}
# Country codes of one and of two digits; all others have three.
ONE_DIGIT, TWO_DIGITS = "^[17]", "^(?:2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
# Days from 1900-01-01 to 2099-12-31 are 73,049 = 17 * 4,297.
FIRST_DAY, LAST_DAY, DAYS = "1900-01-01", "2099-12-31", (17, 4297)


def _long(x) -> Column:
    return (F.lit(x) if isinstance(x, int) else x).try_cast("long")


def feistel(key: str, kind: str, x: Column, y: Column, p, q) -> Column:
    """struct(x, y): the permuted halves."""

    def step(s: Column, i: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), s["y"].cast("string")), 256)
        noise = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
        return F.struct(s["y"].alias("x"), F.pmod(s["x"] + noise, s["p"]).alias("y"), s["q"].alias("p"), s["p"].alias("q"))

    start = F.struct(_long(x).alias("x"), _long(y).alias("y"), _long(p).alias("p"), _long(q).alias("q"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y")))


def _part(s: Column, start: int, length: int) -> Column:
    return _long(F.substring(s, start, length))


def _padded(n: Column, width) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum; every second digit from the right is doubled."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def _redigit(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order by ``digits``."""

    def char(i: Column) -> Column:
        own = F.substr(value, i, F.lit(1))
        nth = F.length(_digits(F.substr(value, F.lit(1), i)))
        return F.when(own.rlike("[0-9]"), F.substr(digits, nth, F.lit(1))).otherwise(own)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), char), "")


def _octet(value: Column, i: int) -> Column:
    return _long(F.get(F.split(value, r"\."), i - 1))


def _iban_rest(text: Column) -> Column:
    """Remainder by 97 of the text as a number, letters standing for 10 to 35."""

    def add(rest: Column, i: Column) -> Column:
        c = F.substr(text, i, F.lit(1))
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)


def _groups(value: Column) -> Column:
    """The eight groups of an IPv6 address; fewer or more if it is none."""
    sides = F.split(value, "::", -1)
    left, right = (F.filter(F.split(F.coalesce(F.get(sides, i), F.lit("")), ":"), lambda g: g != "") for i in (0, 1))
    missing = 8 - F.size(left) - F.size(right)
    zeros = F.when((F.size(sides) == 2) & (missing > 0), F.array_repeat(F.lit("0"), missing)).otherwise(F.array().cast("array<string>"))
    return F.concat(left, zeros, right)


def kind_of(value: Column) -> Column:
    """The kind whose pattern and validation the value passes, else null."""
    digits = _digits(value)
    national = F.right(digits, F.lit(10))
    bare = F.regexp_replace(value, " ", "")
    groups = _groups(value)
    valid = {
        "iban": (_iban_rest(F.concat(F.substr(bare, F.lit(5)), F.substr(bare, F.lit(1), F.lit(4)))) == 1) & (F.length(_digits(F.substr(bare, F.lit(5)))) >= 2),
        "ipv6": (F.size(groups) == 8) & F.forall(groups, lambda g: F.length(g) <= 4) & (F.size(F.split(value, "::", -1)) <= 2) & (F.size(F.filter(F.split(value, ":"), lambda g: g != "")) >= 3) & value.rlike("[0-9]") & ~value.rlike("(?:^|[^:]):$|^:[^:]|:::"),
        "ipv4": F.greatest(*[_octet(value, i) for i in (1, 2, 3, 4)]) <= 255,
        "ssn": _part(digits, 1, 3).between(1, 899) & (_part(digits, 1, 3) != 666) & (_part(digits, 4, 2) > 0) & (_part(digits, 6, 4) > 0),
        "phone": (_part(national, 1, 3) >= 200) & (_part(national, 4, 3) >= 200),
        "phone_abroad": F.length(digits).between(8, 15) & ~digits.rlike("^1"),
        "card": (_luhn_sum(digits) % 10 == 0) & (_long(digits.substr(2, 17)) > 0),
    }
    for kind, form in DATE_FORMATS.items():
        valid[kind] = F.try_to_date(value, form).between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date"))
    out = None
    for kind, pattern in KINDS.items():
        # Nested, so that a value is validated for a kind only if it looks like one.
        fits = F.when(value.rlike(f"^(?:{pattern})$"), valid.get(kind, F.lit(True))).otherwise(F.lit(False))
        out = F.when(fits, F.lit(kind)) if out is None else out.when(fits, F.lit(kind))
    return out


def pseudonym(key: str, kind: Column, value: Column) -> Column:
    """The value's pseudonym; unvalidated values (null kind) stay."""
    digits = _digits(value)
    national = F.right(digits, F.lit(10))
    country = F.substr(digits, F.lit(1), F.length(digits) - 10)

    def keyed(kind: str, text: Column) -> Column:
        return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), text), 256)

    def with_halves(halves: Column, show) -> Column:
        """``show`` of the permuted halves, which are computed once."""
        return F.get(F.transform(F.array(halves), show), 0)

    ipv4 = feistel(key, "ipv4", _octet(value, 1) * 256 + _octet(value, 2), _octet(value, 3) * 256 + _octet(value, 4), 65536, 65536)
    area = _part(digits, 1, 3)
    ssn = feistel(
        key, "ssn", area - 1 - F.when(area > 666, 1).otherwise(0), (_part(digits, 4, 2) - 1) * 9999 + _part(digits, 6, 4) - 1, 898, 99 * 9999
    )
    phone = feistel(key, "phone", _part(national, 1, 3) - 200, (_part(national, 4, 3) - 200) * 10000 + _part(national, 7, 4), 800, 8_000_000)
    inner = F.length(digits) - 2
    left = F.floor(inner / 2).cast("int")
    card = feistel(
        key,
        "card",
        _long(F.substr(digits, F.lit(2), left)),
        _long(F.substr(digits, left + 2, inner - left)),
        F.pow(F.lit(10), left),
        F.pow(F.lit(10), inner - left),
    )

    code = F.when(digits.rlike(ONE_DIGIT), 1).when(digits.rlike(TWO_DIGITS), 2).otherwise(3)
    beyond = F.length(digits) - code
    near = F.floor(beyond / 2).cast("int")
    abroad = feistel(key, "phone_abroad", _long(F.substr(digits, code + 1, near)), _long(F.substr(digits, code + near + 1, beyond - near)), F.pow(F.lit(10), near), F.pow(F.lit(10), beyond - near))
    bare = F.regexp_replace(value, " ", "")
    account = F.substr(bare, F.lit(5))
    own = _digits(account)
    head = F.floor(F.length(own) / 2).cast("int")
    iban = feistel(key, "iban", _long(F.substr(own, F.lit(1), head)), _long(F.substr(own, head + 1, F.length(own) - head)), F.pow(F.lit(10), head), F.pow(F.lit(10), F.length(own) - head))
    groups = _groups(value)

    def pair_of(i: int) -> Column:
        return F.conv(F.concat(*[F.lpad(F.get(groups, k), 4, "0") for k in (i, i + 1)]), 16, 10)

    net = feistel(key, "ipv6_net", pair_of(0), pair_of(2), 1 << 32, 1 << 32)
    host = feistel(key, "ipv6_host", pair_of(4), pair_of(6), 1 << 32, 1 << 32)

    def show_abroad(s: Column) -> Column:
        rest = F.concat(F.lpad(s["x"].cast("string"), near, F.lit("0")), F.lpad(s["y"].cast("string"), beyond - near, F.lit("0")))
        return _redigit(value, F.concat(F.substr(digits, F.lit(1), code), rest))

    def show_iban(s: Column) -> Column:
        n = F.length(own)
        body = _redigit(account, F.concat(F.lpad(s["x"].cast("string"), head, F.lit("0")), F.lpad(s["y"].cast("string"), n - head, F.lit("0"))))
        country = F.substr(bare, F.lit(1), F.lit(2))
        check = F.lpad((98 - _iban_rest(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
        whole = F.concat(country, check, body)

        def char(i: Column) -> Column:
            nth = F.length(F.regexp_replace(F.substr(value, F.lit(1), i), " ", ""))
            return F.when(F.substr(value, i, F.lit(1)) == " ", F.lit(" ")).otherwise(F.substr(whole, nth, F.lit(1)))

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), char), "")

    def show_ipv6(s: Column) -> Column:
        return F.concat_ws(":", *[F.lower(F.lpad(F.hex(x), 4, "0")) for h in ("x", "y") for x in (F.floor(s[h] / 65536).cast("long"), s[h] % 65536)])

    def show_ssn(s: Column) -> Column:
        group, serial = F.floor(s["y"] / 9999) + 1, s["y"] % 9999 + 1
        return _redigit(value, F.concat(_padded(s["x"] + 1 + F.when(s["x"] >= 665, 1).otherwise(0), 3), _padded(group, 2), _padded(serial, 4)))

    def show_phone(s: Column) -> Column:
        return _redigit(value, F.concat(country, _padded(s["x"] + 200, 3), _padded(s["y"] + 2_000_000, 7)))

    def show_card(s: Column) -> Column:
        body = F.concat(F.substring(digits, 1, 1), F.lpad(s["x"].cast("string"), left, F.lit("0")), F.lpad(s["y"].cast("string"), inner - left, F.lit("0")))
        check = (10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
        return _redigit(value, F.concat(body, check.cast("string")))

    def show_ipv4(s: Column) -> Column:
        return F.concat_ws(".", *[x.cast("string") for h in ("x", "y") for x in (F.floor(s[h] / 256), s[h] % 256)])

    def show_date(form: str):
        def show(s: Column) -> Column:
            day = F.date_add(F.lit(FIRST_DAY).cast("date"), (s["x"] * DAYS[1] + s["y"]).cast("int"))
            padded = form.replace("M/d", "MM/dd").replace("d/M", "dd/MM")
            return F.when(F.length(value) == 10, F.date_format(day, padded)).otherwise(F.date_format(day, form))

        return show

    out = (
        F.when(kind == "ipv4", with_halves(ipv4, show_ipv4))
        .when(kind == "ssn", with_halves(ssn, show_ssn))
        .when(kind == "phone", with_halves(phone, show_phone))
        .when(kind == "phone_abroad", with_halves(abroad, show_abroad))
        .when(kind == "iban", with_halves(iban, show_iban))
        .when(kind == "ipv6", F.concat_ws(":", with_halves(net, show_ipv6), with_halves(host, show_ipv6)))
        .when(kind == "card", with_halves(card, show_card))
    )
    for name, form in DATE_FORMATS.items():
        day = F.datediff(F.try_to_date(value, form), F.lit(FIRST_DAY).cast("date")).cast("long")
        halves = feistel(key, "date", F.floor(day / DAYS[1]), day % DAYS[1], *DAYS)
        out = out.when(kind == name, with_halves(halves, show_date(form)))
    at = F.instr(value, "@")
    mail = F.concat(F.lit("u"), F.substring(keyed("email", F.lower(value)), 1, 16), F.substr(value, at))
    secret = F.regexp_extract(value, r"([A-Za-z0-9+/_-]{8,})\"?$", 1)
    before = F.regexp_extract(value, r"^([A-Za-z_]+ ?[=:] ?\"?)", 1)
    digest = keyed("credential", secret)
    masked = F.concat(before, F.substr(F.repeat(digest, 64), F.lit(1), F.length(secret)), F.when(value.endswith('"'), '"').otherwise(""))
    return (
        out.when(kind == "email", mail)
        .when(kind == "credential", masked)
        .when(kind == "access_key", F.concat(F.lit("AKIA"), F.upper(F.substring(keyed("access_key", value), 1, 16))))
        .otherwise(value)
    )


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Replace personal data in whole texts by pseudonyms.

    Returns one row per input row: doc_id, text (with pseudonyms), found
    (kind and pseudonym of every validated value, in text order) and
    n_found.  Kinds: card (Luhn), phone (North American plan, with or without
    separators), phone_abroad (a plus, a country code, which stays, 8 to 15
    digits), iban (remainder 97; country, letters and length stay), ssn, ipv4,
    ipv6 (shown in full, network and host apart) and four date formats (1900
    to 2099; dates are linked across formats, with slashes they are read day
    first only where month first gives no date) are permuted in their format;
    email keeps its domain; credential (names in any case) and access_key
    keep their make.

    Defined cases: a null text stays null, with nothing found; look-alikes
    that fail validation stay as they are (a wrong check digit, an impossible
    date, an octet over 255); a value that touches another digit is no value;
    repeated rows and null ids are answered row by row; an empty table gives
    an empty result; other columns are ignored.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    nothing = F.array().cast("array<string>")
    any_value = F.lit(ANY)
    matched = rows.withColumn("values", F.coalesce(F.regexp_extract_all("text", any_value, F.lit(0)), nothing))
    named = matched.withColumn("named", F.transform("values", lambda v: F.struct(kind_of(v).alias("kind"), v.alias("value"))))
    replaced = named.withColumn("put", F.transform("named", lambda x: F.struct(x["kind"].alias("kind"), pseudonym(key, x["kind"], x["value"]).alias("pseudonym"))))
    gaps = F.split("text", ANY, -1)
    woven = F.zip_with(gaps, "put", lambda gap, x: F.concat(gap, F.coalesce(x["pseudonym"], F.lit(""))))
    found = F.filter("put", lambda x: x["kind"].isNotNull())
    return replaced.select(
        "doc_id",
        F.when(F.size("put") > 0, F.array_join(woven, "")).otherwise(F.col("text")).alias("text"),
        found.alias("found"),
        F.size(found).cast("long").alias("n_found"),
    )
