"""Column functions on edge rows."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwork import functions as fn
from tillwork.functions.calling_codes import CALLING_CODE_LENGTHS, lengths

D = Decimal


def apply(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make("v")).collect()]


def test_text(spark):
    values = ["  ada   marie ", " anz ", "north  ocean", "china", "Africa", "a\tb", None]
    assert apply(spark, values, lambda c: fn.clean_text_standard(c, is_acronym=True)) == [
        "Ada Marie", "ANZ", "North Ocean", "CHINA", "Africa", "A B", None]
    assert apply(spark, values, fn.clean_text_standard) == [
        "Ada Marie", "Anz", "North Ocean", "China", "Africa", "A B", None]
    assert apply(spark, [" Mc  Donald "], lambda c: fn.clean_text_standard(c, enforce_title_case=False)) == ["Mc Donald"]
    assert apply(spark, [" a \n  b ", None], fn.clean_spaces) == ["a b", None]


def test_email(spark):
    values = [" Ada@Mail.Example.ORG ", "ada@mail", "", None, "a b@x.org"]
    assert apply(spark, values, fn.clean_email)[:1] == ["ada@mail.example.org"]
    assert apply(spark, values, lambda c: fn.is_verified_email(fn.clean_email(c))) == [
        True, False, False, None, False]


PHONES = {
    "(212) 555-0147 x12": "+12125550147",
    "001-212-555-0147": "+12125550147",
    "+44 20 7946 0000": "+442079460000",
    "(495)657-9887x74924": "+14956579887",
    "212.555.0147 ext. 9": "+12125550147",
    "1-212-555-0147": "+12125550147",
    "555-0147": "+15550147",
    "+0 212 555 0147": None,
    "212 555 01478": None,
    "12345": None,
    "+1 212 555": None,
    "+33 1 23 45 67 89": "+33123456789",
    "+33 1 23 45 67": None,
    "0035121 123 4567": "+351211234567",
    "+351 21 123 456": None,
    "+7 495 123 45 67": "+74951234567",
    "+7 495 123 45": None,
    "+999 1234567": "+9991234567",
    "+999 123": None,
    "": None,
    "n/a": None,
    None: None,
}


def test_phone(spark):
    values = list(PHONES)
    assert apply(spark, values, fn.format_phone_e164) == list(PHONES.values())
    assert apply(spark, values, fn.is_verified_phone) == [v is not None for v in PHONES.values()]
    assert apply(spark, ["+1 (2) 3a", None], fn.clean_phone) == ["+123", None]
    again = apply(spark, values, lambda c: fn.format_phone_e164(fn.format_phone_e164(c)))
    assert again == list(PHONES.values())


def test_dates(spark):
    values = ["2025-03-04", "2025-03-04T05:06:07", "04/03/2025", "2025-02-30", "2025-03-04 05:06:07",
              "2025-11-03T06:07:08.009Z", "2025-3-4", "", None]
    assert apply(spark, values, fn.standardize_date) == [
        datetime(2025, 3, 4), datetime(2025, 3, 4, 5, 6, 7)] + [None] * 7
    moment = datetime(2025, 3, 4, 5, 6, 7, 890)
    assert apply(spark, [moment, None], fn.standardize_date, "timestamp") == [moment, None]


def test_numbers(spark):
    assert apply(spark, [" 12 ", "abc", None, "99999999999"], fn.cast_to_integer) == [12, 0, 0, 0]
    assert apply(spark, ["abc"], lambda c: fn.cast_to_integer(c, 7)) == [7]
    small = lambda c: fn.cast_to_decimal(c, 5, 3)
    assert apply(spark, ["123.4", "0.2001", None], small) == [D("0.000"), D("0.200"), D("0.000")]
    assert apply(spark, ["0.125", "x"], lambda c: fn.cast_to_decimal(c, default_val=1.5)) == [D("0.13"), D("1.50")]


def test_booleans(spark):
    assert apply(spark, [" TRUE", "false", "maybe", None], fn.cast_to_boolean) == [True, False, False, False]
    assert apply(spark, [None, "no"], lambda c: fn.cast_to_boolean(c, True)) == [True, False]


def test_ids(spark):
    assert apply(spark, [" NULL ", "null", " c9", None], fn.null_text) == [None, None, "C9", None]
    assert apply(spark, [" aB "], fn.upper_trim) == ["AB"]
    assert apply(spark, [" aB "], fn.lower_trim) == ["ab"]
    assert apply(spark, [" /x "], fn.trim_only) == ["/x"]


def test_full_name(spark):
    df = spark.createDataFrame([("Ada", "May"), ("Ada", None)], "a string, b string")
    assert [r[0] for r in df.select(fn.full_name("a", "b")).collect()] == ["Ada May", None]


def test_search_term(spark):
    data = [("SEARCH", "/s?q=lamp&p=2", "lamp"), ("SEARCH", "/s?p=1&q=a#b", "a#b"), ("SEARCH", "/s?q=", None),
            ("PAGE_VIEW", "/s?q=lamp", None), ("SEARCH", None, None), (None, "/s?q=x", None)]
    df = spark.createDataFrame(data, "e string, u string, want string")
    assert df.filter(~fn.search_term("e", "u").eqNullSafe(F.col("want"))).isEmpty()


def test_event_flags(spark):
    df = spark.createDataFrame([("PURCHASE", "DESKTOP"), ("ERROR", "TV"), (None, None)], "e string, d string")
    flags = df.select(fn.is_event_allowed("e"), fn.is_device_allowed("d")).collect()
    assert [tuple(r) for r in flags] == [(True, True), (False, False), (None, None)]


@pytest.mark.parametrize(
    "quantity, price, discount, total, right",
    [(3, "19.99", "0.15", "50.97", True), (5, "0.07", "0.30", "0.25", True), (1, "5.00", "0.00", "1.00", False),
     (2_000_000_000, "99999999.99", "0.00", "1.00", False)],
)
def test_price_flag(spark, quantity, price, discount, total, right):
    df = spark.createDataFrame(
        [(quantity, D(price), D(discount), D(total))],
        "q int, p decimal(10,2), d decimal(10,2), t decimal(10,2)")
    assert df.select(fn.is_pricing_correct("t", "q", "p", "d")).first()[0] is right


def test_time_flag(spark):
    day = [datetime(2025, 1, d) for d in (1, 2)]
    data = [(day[0], day[1]), (day[0], day[0]), (day[1], day[0]), (day[0], None)]
    df = spark.createDataFrame(data, "t timestamp, m timestamp")
    assert [r[0] for r in df.select(fn.is_time_valid("t", "m")).collect()] == [True, True, False, None]


def test_margin(spark):
    data = [("80.00", "60.00", "25.00"), ("60.00", "60.00", "0.00"), ("50.00", "60.00", "0.00"),
            ("0.00", "0.00", "0.00"), ("80.00", "55.00", "31.25")]
    df = spark.createDataFrame([tuple(D(x) for x in r) for r in data],
                               "p decimal(10,2), c decimal(10,2), want decimal(5,2)")
    margin = fn.gross_margin_percentage("p", "c", fn.is_margin_positive("p", "c"))
    result = df.select(margin.alias("m"), "want")
    assert result.schema["m"].dataType.simpleString() == "decimal(5,2)"
    assert result.filter("m <> want OR m IS NULL").isEmpty()


def test_reorder(spark):
    df = spark.createDataFrame([(10, 10), (11, 10)], "s int, t int")
    assert [r[0] for r in df.select(fn.is_reorder_needed("s", "t")).collect()] == [True, False]


def test_defaults_never_null(spark):
    df = spark.createDataFrame([("x",)], "v string").select(
        fn.cast_to_integer("v").alias("i"), fn.cast_to_decimal("v").alias("d"), fn.cast_to_boolean("v").alias("b"))
    assert [f.nullable for f in df.schema] == [False, False, False]


def _texts(alphabet, count=400, longest=18, seed=7):
    import random

    pick = random.Random(seed)
    return ["".join(pick.choice(alphabet) for _ in range(pick.randint(0, longest))) for _ in range(count)]


def test_no_calling_code_begins_another():
    codes = list(CALLING_CODE_LENGTHS)
    assert not [(a, b) for a in codes for b in codes if a != b and b.startswith(a)]
    assert lengths("4-6 9") == {4, 5, 6, 9}


def test_phone_against_plain_rules(spark):
    import re

    def expected(text):
        text = text.strip(" ")
        text = "+" + text[2:] if text.startswith("00") else text
        text = re.split(r"\s*(?:;?ext|x|#)", text, maxsplit=1, flags=re.I)[0]
        digits = re.sub(r"[^0-9]", "", text)
        if not text.startswith("+"):
            if len(digits) in (7, 10):
                return "+1" + digits
            return "+" + digits if len(digits) == 11 and digits[0] == "1" else None
        if digits.startswith("0"):
            return None
        for n in (3, 2, 1):
            if digits[:n] in CALLING_CODE_LENGTHS and len(digits) >= 6:
                return "+" + digits if len(digits) - n in lengths(CALLING_CODE_LENGTHS[digits[:n]]) else None
        return "+" + digits if 7 <= len(digits) <= 15 else None

    values = _texts("0123456789012345678901234567890123456789+-() x") + ["00" + t for t in _texts("0123456789 ", 200)]
    values += ["+" + t for t in _texts("0123456789 ", 600)] + ["1" + t for t in _texts("0123456789", 200, 12)]
    found = apply(spark, values, fn.format_phone_e164)
    assert sum(v is not None for v in found) > 100
    assert [(v, f) for v, f in zip(values, found) if f != expected(v)] == []


def test_text_and_url_against_plain_rules(spark):
    import re

    values = _texts("aB c  Dé\t\n.")
    squeezed = [re.sub(r"[ \t\n]+", " ", v).strip(" ") for v in values]
    titled = [" ".join(w[:1].upper() + w[1:].lower() for w in s.split(" ")) for s in squeezed]
    assert apply(spark, values, fn.clean_spaces) == squeezed
    assert apply(spark, values, fn.clean_text_standard) == titled
    assert apply(spark, values, lambda c: fn.clean_text_standard(c, is_acronym=True)) == [
        s.upper() if len(s) <= 5 and " " not in s else t for s, t in zip(squeezed, titled)]
    urls = _texts("?&q==ab#")
    found = [re.search(r"[?&]q=([^&]+)", u) for u in urls]
    assert apply(spark, urls, lambda c: fn.search_term(F.lit("SEARCH"), c)) == [m and m.group(1) for m in found]


def test_dates_against_plain_rules(spark):
    import re

    def expected(text):
        if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9]{2}:[0-9]{2}:[0-9]{2})?", text):
            return None
        try:
            return datetime.fromisoformat(text)
        except ValueError:
            return None

    import random

    pick = random.Random(3)
    values = []
    for _ in range(400):
        day = f"20{pick.randint(0, 39):02d}-{pick.randint(0, 13):02d}-{pick.randint(0, 32):02d}"
        clock = f"{pick.randint(0, 24):02d}:{pick.randint(0, 60):02d}:{pick.randint(0, 60):02d}"
        values.append(pick.choice([day, f"{day}T{clock}", f"{day} {clock}", f"{day}T{clock}Z", f" {day}"]))
    found = apply(spark, values, fn.standardize_date)
    assert sum(v is not None for v in found) > 100
    assert [(v, f) for v, f in zip(values, found) if f != expected(v)] == []
