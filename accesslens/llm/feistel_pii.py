"""Personal numbers and dates under format-preserving Feistel pseudonyms, in column expressions only.

A pattern proposes values, a check of their kind decides (Luhn, IBAN remainder, calendar, octets,
number ranges), and a valid value becomes a number in the domain of its format.  A Feistel
network over two unequal halves, keyed by SHA-256, permutes that domain; the result is written
back into the same format with its check digits renewed.  A value has one pseudonym
everywhere, and different values have different ones: links between documents survive.
Addresses of mail, which have no fixed domain, get a keyed name in front of their host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import table, texts

ROUNDS = 10
KEY = "accesslens"
#: Dates from here on are permuted, to the last day of 2100.
FIRST_DAY = "1900-01-01"
#: Months there, and days after the twelfth of a month, as factors of the two domains.
MONTHS, LATE_DAYS = 2412, (4447, 10)

#: Countries by the length of their account numbers; what follows such a number is not part of it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST",
    26: "IS|TR", 27: "FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE",
    31: "MT|SC", 32: "LC", 33: "RU",
}
_IBANS = "|".join(
    rf"(?:{names})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + r"(?!\w)" for n, names in IBAN_LENGTHS.items()
)
#: Country codes of telephone numbers; all others have three digits.
DIALLING = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"

#: Fixed formats by kind, in order of preference where several begin at one place.
FORMATS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": rf"(?<!\w)(?:{_IBANS})|" + r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "date": r"(?<![\w/-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\w/-]|\.\d)",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\w)"
    r"|(?<!\w)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
    r"|(?<![\w+])\+[1-9](?:[ .()-]{0,2}\d){7,14}(?!\w)|(?<![\w-])1[ .-]\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])",
    "card": r"(?<!\w)(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w)",
}
PATTERN = "|".join(FORMATS.values())
#: How a whole match shows its kind.
SHAPES = {
    "email": "@",
    "iban": "^[A-Z]",
    "date": r"^(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})$",
    "ip": r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$",
    "ssn": r"^\d{3}-\d{2}-\d{4}$",
    "phone": r"^[+(]|^(?:1[ .-]\d{3}[ .-]|\d{3}[.-])\d{3}[ .-]\d{4}$",
}


def _long(x) -> Column:
    return F.lit(x).cast("long") if isinstance(x, int) else x.cast("long")


def _div(n: Column, b: Column) -> Column:
    """Whole quotient of numbers from 0 on, exact for longs."""
    return F.call_function("div", n, b)


def _power10(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def feistel(n: Column, a, b, kind: Column, key: str, backwards: bool = False) -> Column:
    """Keyed permutation of 0 .. a x b - 1; a and b at most 10^9, numbers or columns."""
    a, b = _long(a), _long(b)

    def noise(half: Column, turn: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), kind, a.cast("string"), b.cast("string"), turn.cast("string"), half.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

    def step(s: Column, turn: Column) -> Column:
        sign = -1 if backwards else 1
        even = F.struct(F.pmod(s.l + sign * F.pmod(noise(s.r, turn), a), a).alias("l"), s.r.alias("r"))
        odd = F.struct(s.l.alias("l"), F.pmod(s.r + sign * F.pmod(noise(s.l, turn), b), b).alias("r"))
        return F.when(turn % 2 == 0, even).otherwise(odd)

    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if backwards else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    start = F.struct(_div(n, b).alias("l"), F.pmod(n, b).alias("r"))
    return F.aggregate(turns, start, step, lambda s: s.l * b + s.r)


def permute_digits(digits: Column, kind: Column, key: str, backwards: bool = False) -> Column:
    """A string of up to 18 digits, permuted among those of its length; of none, itself."""
    n = F.length(digits)
    half = (n / 2).cast("int")
    moved = feistel(digits.cast("long"), _power10(n - half), _power10(half), kind, key, backwards)
    return F.when(n > 0, F.lpad(moved.cast("string"), n, "0")).otherwise("")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(value: Column, digits: Column) -> Column:
    """The value with its digits replaced one by one."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def put(s: Column, c: Column) -> Column:
        isdigit = c.between("0", "9")
        out = F.concat(s.out, F.when(isdigit, F.substr(digits, s.at, F.lit(1))).otherwise(c))
        return F.struct(out.alias("out"), (s.at + isdigit.cast("int")).alias("at"))

    return F.aggregate(F.split(value, ""), start, put, lambda s: s.out)


def _luhn(digits: Column, first_doubled: bool) -> Column:
    """Luhn sum of digits from the right; first_doubled: whether the last digit counts double."""

    def term(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when((i % 2 == 0) == first_doubled, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), term), F.lit(0), lambda s, x: s + x)


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    moved = permute_digits(body, F.lit("card"), key)
    check = F.pmod(10 - _luhn(moved, True) % 10, F.lit(10))
    return F.when(_luhn(digits, False) % 10 == 0, _refill(value, F.concat(moved, check.cast("string"))))


def _mod97(text: Column) -> Column:
    def add(s: Column, c: Column) -> Column:
        letter = c.between("A", "Z")
        return F.when(letter, (s * 100 + F.ascii(c) - 55) % 97).otherwise((s * 10 + F.ascii(c) - 48) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _iban(value: Column, key: str) -> Column:
    plain = F.regexp_replace(value, " ", "")
    country, body = F.substring(plain, 1, 2), F.substr(plain, F.lit(5), F.length(plain))
    valid = (_mod97(F.concat(body, F.substring(plain, 1, 4))) == 1) & F.length(plain).between(15, 34)
    digits = _digits(body)
    parts = [F.substring(digits, 1, 15), F.substring(digits, 16, 15)]
    moved = F.concat(*[permute_digits(p, F.concat(F.lit(f"iban{i}"), country), key) for i, p in enumerate(parts)])
    new = _refill(body, moved)
    check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    # letters keep their places, so digits of the checks and the body go back in order
    return F.when(valid, _refill(value, F.concat(check, moved)))


def _ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    valid = F.forall(octets, lambda x: x <= 255)
    n = F.aggregate(octets, _long(0), lambda s, x: s * 256 + x)
    moved = feistel(n, 1 << 16, 1 << 16, F.lit("ip"), key)
    out = F.concat_ws(".", *[(F.shiftright(moved, s).bitwiseAND(255)).cast("string") for s in (24, 16, 8, 0)])
    return F.when(valid, out)


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.split(value, "-")[i].cast("long") for i in range(3))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    row = area - 1 - (area > 666).cast("long")  # 898 areas
    n = row * (99 * 9999) + (group - 1) * 9999 + serial - 1
    moved = feistel(n, 898, 99 * 9999, F.lit("ssn"), key)
    row, rest = _div(moved, _long(99 * 9999)), moved % (99 * 9999)
    area = row + 1 + (row >= 665).cast("long")
    group, serial = _div(rest, _long(9999)) + 1, rest % 9999 + 1
    pad = [F.lpad(x.cast("string"), n, "0") for x, n in ((area, 3), (group, 2), (serial, 4))]
    return F.when(valid, F.concat_ws("-", *pad))


def _phone(value: Column, key: str) -> Column:
    digits = _digits(value)
    code = F.when(value.startswith("+"), F.regexp_extract(digits, DIALLING, 0)).otherwise(F.substr(digits, F.lit(1), F.length(digits) - 10))
    rest = F.substr(digits, F.length(code) + 1, F.length(digits))
    return _refill(value, F.concat(code, permute_digits(rest, F.lit("phone"), key)))


def _day(text: Column, form: str) -> Column:
    return F.try_to_timestamp(text, F.lit(form)).cast("date")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def permute_day(day: Column, key: str) -> Column:
    """Another day; null outside the domain.  Days up to the twelfth of a month and later ones are permuted apart.

    Where the order of day and month is read off the value, a day after the twelfth must not turn into one that
    reads in both orders: two days would have one pseudonym.
    """
    first = F.lit(FIRST_DAY).cast("date")

    def month(d: Column) -> Column:
        return ((F.year(d) - 1900) * 12 + F.month(d) - 1).cast("long")

    def early(n: Column) -> Column:
        return F.date_add(F.add_months(first, _div(n, _long(12)).cast("int")), (n % 12).cast("int"))

    def late(n: Column) -> Column:
        # days after the twelfth in a row: each month leaves out twelve; n lies in the month near its share of all, give or take two
        near = _div(n * MONTHS, _long(LATE_DAYS[0] * LATE_DAYS[1]))
        months = F.transform(F.sequence(near - 2, near + 2), lambda m: F.struct(m.alias("m"), F.date_add(first, (n + 12 * (m + 1)).cast("int")).alias("d")))
        return F.get(F.filter(months, lambda x: (month(x.d) == x.m) & (F.dayofmonth(x.d) > 12)), 0).d

    def moved(d: Column) -> Column:
        at = F.dayofmonth(d).cast("long")
        low = _let(feistel(month(d) * 12 + at - 1, MONTHS, 12, F.lit("date"), key), early)
        high = _let(feistel(F.datediff(d, first).cast("long") - 12 * (month(d) + 1), *LATE_DAYS, F.lit("late date"), key), late)
        return F.when(month(d).between(0, MONTHS - 1), F.when(at <= 12, low).otherwise(high))

    return _let(day, moved)


def _date(value: Column, key: str) -> Column:
    """Day first where both orders are days; the order of the value is kept."""
    forms = ((r"^\d{4}-", "yyyy-MM-dd"), (r"^\d{2}/", "dd/MM/yyyy"), (r"^\d{2}/", "MM/dd/yyyy"), (r"^\d{2}\.", "dd.MM.yyyy"))
    days = F.array(*[_day(F.when(value.rlike(shape), value), form) for shape, form in forms])

    def written(days: Column) -> Column:
        at = F.array_position(F.transform(days, lambda d: d.isNotNull()), True)  # from 1; 0 where none is a day
        texts_ = lambda d: F.array(*[F.date_format(d, form) for _, form in forms])
        return F.when(at > 0, _let(permute_day(F.get(days, (at - 1).cast("int")), key), lambda d: F.get(texts_(d), (at - 1).cast("int"))))

    return _let(days, written)


def _email(value: Column, key: str) -> Column:
    name = F.substring(F.sha2(F.concat(F.lit(f"{key}|email|"), F.lower(value)), 256), 1, 26)
    return F.concat(F.lit("u"), name, F.regexp_extract(value, "@.*$", 0))


_KINDS = {"email": _email, "iban": _iban, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _card}


def kind_of(value: Column) -> Column:
    out = F
    for kind, shape in SHAPES.items():
        out = out.when(value.rlike(shape), kind)
    return out.otherwise("card")


def pseudonym(value: Column, key: str = KEY) -> Column:
    """Pseudonym of a matched value; null if its kind's check rejects it."""
    out = F
    for name, make in _KINDS.items():
        out = out.when(kind_of(value) == name, make(value, key))
    return out


def pseudonymise(docs: DataFrame, key: str = KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, found): every input row with the new text and its (kind, pseudonym) in order.

    A null text stays null with nothing found; empty texts and texts without values come back as they
    are, very long ones are searched whole.  Values that fail their check stay as they are.  Repeated rows and null ids keep their rows.
    An empty table gives no rows.
    """
    rows = texts(docs, id_col, text_col)
    maybe = F.col("text").rlike("[0-9@]")  # every pattern holds a digit or this mark
    hits = F.when(maybe, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
    rows = rows.withColumn("hits", hits)
    none = F.array().cast("array<struct<kind:string,old:string,new:string>>")
    made = F.transform("hits", lambda v: F.struct(kind_of(v).alias("kind"), v.alias("old"), pseudonym(v, key).alias("new")))
    rows = rows.withColumn("made", F.when(F.size("hits") > 0, made).otherwise(none))
    values = F.transform("made", lambda m: F.coalesce(m.new, m.old))
    parts = F.split("text", PATTERN, -1)
    text = F.array_join(F.zip_with(parts, values, lambda p, v: F.concat(p, F.coalesce(v, F.lit("")))), "")
    changed = F.exists("made", lambda m: m.new.isNotNull())
    found = F.transform(F.filter("made", lambda m: m.new.isNotNull()), lambda m: F.struct(m.kind.alias("kind"), m.new.alias("pseudonym")))
    return rows.select("doc_id", F.when(changed, text).otherwise(F.col("text")).alias("text"), found.alias("found"))


def op2_feistel_pii(spark, sf_dir: str) -> DataFrame:
    """Documents without personal values; ``found`` as kind:pseudonym, comma-joined."""
    out = pseudonymise(table(spark, sf_dir, "documents"))
    names = F.array_join(F.transform("found", lambda x: F.concat_ws(":", x.kind, x.pseudonym)), ",")
    return out.select("doc_id", "text", F.size("found").cast("long").alias("n_found"), names.alias("found"))


QUERIES = {"op2_feistel_pii": op2_feistel_pii}
ORACLE: dict[str, str] = {}
