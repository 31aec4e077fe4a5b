import datetime as dt
import hashlib
import re

from plain import ODD
from pyspark.sql import functions as F

from accesslens.llm import feistel_pii as op


def plain_feistel(n, a, b, kind, key=op.KEY):
    """The same network in plain integers."""
    left, right = divmod(n, b)
    for turn in range(op.ROUNDS):
        half = right if turn % 2 == 0 else left
        digest = hashlib.sha256("|".join(map(str, (key, kind, a, b, turn, half))).encode()).hexdigest()
        if turn % 2 == 0:
            left = (left + int(digest[:15], 16) % a) % a
        else:
            right = (right + int(digest[:15], 16) % b) % b
    return left * b + right


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def iban_ok(value):
    x = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def of(spark, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.select("i", column(F.col("v")).alias("out")).orderBy("i").select("out").collect()]


def test_permutes_small_domains_and_back(spark):
    for a, b in ((7, 11), (1, 13), (27, 3)):
        n = F.col("id")
        there = op.feistel(n, a, b, F.lit("x"), "k")
        back = op.feistel(F.col("y"), a, b, F.lit("x"), "k", backwards=True)
        rows = spark.range(a * b).select("id", there.alias("y")).select("id", "y", back.alias("z")).collect()
        assert sorted(r["y"] for r in rows) == list(range(a * b))
        assert all(r["z"] == r["id"] for r in rows)
        assert [r["y"] for r in sorted(rows, key=lambda r: r["id"])] == [plain_feistel(i, a, b, "x", "k") for i in range(a * b)]


VALUES = [
    "4111111111111111", "4111 1111 1111 1111", "3782-822463-10005", "9807915762804490",
    "192.168.0.1", "300.1.1.1", "219-09-9999", "666-09-9999", "219-00-1234",
    "2024-02-29", "29.02.2024", "29/02/2024", "02/29/2024", "2023-02-29", "1850-01-01",
    "+1 (974) 555-3436", "(974) 555-3436", "974-555-3436",
    "DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819", "DE00370400440532013000",
    "Some.One+tag@mail.example.org",
]


def test_formats_and_checks(spark):
    new = dict(zip(VALUES, of(spark, VALUES, op.pseudonym)))
    rejected = {"9807915762804490", "300.1.1.1", "666-09-9999", "219-00-1234", "2023-02-29", "1850-01-01", "DE00370400440532013000"}
    assert {v for v, n in new.items() if n is None} == rejected
    for old, value in new.items():
        if value and "@" not in old:
            assert re.sub(r"\d", "9", old) == re.sub(r"\d", "9", value) or "." in old
            assert value != old
    assert all(luhn(re.sub(r"\D", "", new[v])) for v in VALUES[:3])
    assert new[VALUES[1]].replace(" ", "") == new[VALUES[0]]  # one number, two formats
    digits = plain_feistel(411111111111111, 10**8, 10**7, "card")
    assert new[VALUES[0]][:15] == f"{digits:015d}"
    days = {dt.date.fromisoformat(new["2024-02-29"]), dt.datetime.strptime(new["29.02.2024"], "%d.%m.%Y").date()}
    days |= {dt.datetime.strptime(new["29/02/2024"], "%d/%m/%Y").date(), dt.datetime.strptime(new["02/29/2024"], "%m/%d/%Y").date()}
    assert len(days) == 1
    assert iban_ok(new["DE89 3704 0044 0532 0130 00"]) and iban_ok(new["GB29NWBK60161331926819"])
    assert new["GB29NWBK60161331926819"][4:8] == "NWBK"
    area, group, serial = map(int, new["219-09-9999"].split("-"))
    assert 0 < area < 900 and area != 666 and group and serial
    assert all(0 <= int(x) <= 255 for x in new["192.168.0.1"].split("."))
    assert new["Some.One+tag@mail.example.org"].endswith("@mail.example.org")
    assert new["974-555-3436"].replace("-", "") in re.sub(r"\D", "", new["+1 (974) 555-3436"])
    assert len({n for n in new.values() if n}) == len(VALUES) - len(rejected)


def test_texts(spark, odd, empty):
    text = "é 4111111111111111, 4111111111111111. x@y.org 12 9807915762804490 on 2024-02-29."
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(50, text), (51, "see " + text)], "doc_id long, text string"))
    rows = {r["doc_id"]: r for r in op.pseudonymise(docs).collect()}
    assert [x["kind"] for x in rows[50]["found"]] == ["card", "card", "email", "date"]
    card = rows[50]["found"][0]["pseudonym"]
    assert rows[50]["text"].startswith(f"é {card}, {card}. u") and " 9807915762804490 on " in rows[50]["text"]
    assert rows[51]["text"] == "see " + rows[50]["text"]  # linked
    assert all(rows[d]["text"] == t and not rows[d]["found"] for d, t, *_ in ODD)
    assert op.pseudonymise(docs).count() == len(ODD) + 2
    assert op.pseudonymise(empty).count() == 0
    other = {r["doc_id"]: r for r in op.pseudonymise(docs, "another key").collect()}
    assert other[50]["found"][0]["pseudonym"] != card


def test_whole_table_and_plan(spark, small):
    rows = {r["doc_id"]: r for r in op.op2_feistel_pii(spark, "/root/testdata/sf0.001").collect()}
    pattern = re.compile(r"[\w.+-]+@[\w-]+\.[\w.]+|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.]\d)|\+\d \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)")
    old = {m for r in small for m in pattern.findall(r["text"]) if len(m) != 16 or luhn(m)}
    assert old and not any(v in r["text"] for v in old for r in rows.values())
    assert len(rows) == len(small)
    assert all(re.sub(r"\S", "", rows[r["doc_id"]]["text"]) == re.sub(r"\S", "", r["text"]) for r in small)
    plan = op.op2_feistel_pii(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_every_day_of_a_century_has_its_own_pseudonym_in_all_orders(spark):
    """Each string of each form is read as the engine reads it; no two days may share a pseudonym."""
    first = dt.date(1950, 1, 1)
    days = [first + dt.timedelta(i) for i in range(36_525)]
    forms = ("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d.%m.%Y")
    values = sorted({d.strftime(f) for d in days for f in forms})

    def read(text):
        for f in forms:
            try:
                return dt.datetime.strptime(text, f).date()
            except ValueError:
                pass

    new = dict(zip(values, of(spark, values, op.pseudonym)))
    assert None not in new.values()
    image, source = {}, {}
    for old, value in new.items():
        assert re.sub(r"\d", "9", old) == re.sub(r"\d", "9", value)
        image.setdefault(read(old), set()).add(read(value))
        assert source.setdefault(value, read(old)) == read(old)  # one pseudonym, one day
    assert all(len(x) == 1 for x in image.values())  # one day, one pseudonym in all forms
    assert len(set().union(*image.values())) == len(image)
    assert all((d.day > 12) == (next(iter(x)).day > 12) for d, x in image.items())


def test_days_are_permuted_over_the_whole_domain(spark):
    last = (dt.date(2100, 12, 31) - dt.date(1900, 1, 1)).days + 1
    assert 12 * op.MONTHS + op.LATE_DAYS[0] * op.LATE_DAYS[1] == last
    days = spark.range(-1, last + 1).select(F.date_add(F.lit(op.FIRST_DAY).cast("date"), F.col("id").cast("int")).alias("d"))
    rows = days.select("d", op.permute_day(F.col("d"), "k").alias("p")).collect()
    inside = [r["p"] for r in rows if dt.date(1900, 1, 1) <= r["d"] <= dt.date(2100, 12, 31)]
    assert len(set(inside)) == last and None not in inside
    assert [r["p"] for r in rows if r["d"] in (dt.date(1899, 12, 31), dt.date(2101, 1, 1))] == [None, None]


def test_short_values_and_greedy_neighbours_are_found(spark):
    def iban(country, body):
        digits = "".join(str(int(c, 36)) for c in body + country + "00")
        return f"{country}{98 - int(digits) % 97:02d}{body}"

    spaced = lambda x: " ".join(x[i : i + 4] for i in range(0, len(x), 4))
    ibans = [iban(c.split("|")[0], ("80000000608010167519" * 2)[: n - 4]) for n, c in op.IBAN_LENGTHS.items()]
    texts = ["dns 8.8.8.8 is up", "a@b.c", *[f"to {spaced(x)} BIC" for x in ibans], *[f"to {x} BIC" for x in ibans]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [r for r in op.pseudonymise(docs).orderBy("doc_id").collect()]
    assert [len(r["found"]) for r in rows] == [1] * len(texts)
    for r, old in zip(rows, texts):
        assert r["text"] != old and (not old.endswith(" BIC") or r["text"].endswith(" BIC"))
    assert all(iban_ok(r["text"][3:-4]) for r in rows[2:])
    assert len(rows[1]["found"][0]["pseudonym"].split("@")[0]) >= 27


def test_numbers_equal_plain_integers(spark):
    values = ["192.168.0.1", "219-09-9999", "+1 (974) 555-3436", "DE89 3704 0044 0532 0130 00"]
    ip, ssn, phone, iban = of(spark, values, op.pseudonym)
    n = plain_feistel(192 << 24 | 168 << 16 | 1, 1 << 16, 1 << 16, "ip")
    assert ip == ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    n = plain_feistel(218 * 99 * 9999 + 8 * 9999 + 9998, 898, 99 * 9999, "ssn")
    row, rest = divmod(n, 99 * 9999)
    assert ssn == f"{row + 1 + (row >= 665):03d}-{rest // 9999 + 1:02d}-{rest % 9999 + 1:04d}"
    assert re.sub(r"\D", "", phone) == f"1{plain_feistel(9745553436, 10**5, 10**5, 'phone'):010d}"
    parts = [plain_feistel(370400440532013, 10**8, 10**7, "iban0DE"), plain_feistel(0, 10**2, 10, "iban1DE")]
    assert iban.replace(" ", "")[4:] == f"{parts[0]:015d}{parts[1]:03d}"
