"""Account numbers before an upper-case word, and telephone numbers in other groupings."""

import re

from accesslens.llm import feistel_pii as op

IBANS = ["ES91 2100 0418 4502 0005 1332", "BE71 0961 2345 6769", "ES9121000418450200051332", "DE89 3704 0044 0532 0130 00"]
PHONES = ["+44 20 7946 0958", "+33 1 23 45 67 89", "+49 30 1234567", "+34 612 345 678", "1-800-555-0199", "+1 (974) 555-3436"]


def test_values_among_other_words(spark):
    rows = [(i, f"see {v} BIC: ABCD or") for i, v in enumerate(IBANS)] + [(i + 10, f"call {v}, now") for i, v in enumerate(PHONES)]
    got = {r["doc_id"]: r for r in op.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, old in rows:
        kind = "iban" if d < 10 else "phone"
        assert [x["kind"] for x in got[d]["found"]] == [kind], old
        assert got[d]["text"] != old and re.sub(r"\d", "9", got[d]["text"]) == re.sub(r"\d", "9", old)
        new = got[d]["found"][0]["pseudonym"].replace(" ", "")
        assert kind == "phone" or int("".join(str(int(c, 36)) for c in new[4:] + new[:4])) % 97 == 1
    assert got[0]["found"][0]["pseudonym"].replace(" ", "") == got[2]["found"][0]["pseudonym"]
    codes = [got[10 + i]["found"][0]["pseudonym"][:3] for i in range(4)]
    assert codes == ["+44", "+33", "+49", "+34"]
