"""Validators, normal forms, canonical text and quality, on known values."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from quillon.functions import normalizers, quality, validators
from quillon.schema import PAGE_SEP, canonical_text, page_of, page_spans, preview, runner_up, sanitize, sanitize_fixed_width


def each(spark, values, column):
    rows = spark.createDataFrame(list(enumerate(values)), "n int, v string").select("n", column(F.col("v")).alias("x"))
    return [r.x for r in sorted(rows.collect(), key=lambda r: r.n)]


GOOD = {
    "pan": ["AAPFU0939F", "AAAPZ1234C", "AABCU9603R", "ABCPD1234E", " aapfu0939f "],
    "aadhaar": ["269837654322", "2698 3765 4322", "2698-3765-4322"],
    "gstin": ["27AAPFU0939F1ZV", "29AAGCB7383J1Z4"],
    "luhn": ["4539578763621486", "4111111111111111", "5500005555555559", "378282246310005", "4539 5787 6362 1486"],
    "ifsc": ["HDFC0001234", "SBIN0000456", "UTIB0000123"],
    "email": ["a@b.co", "x.y+z@sub.example.org"],
    "phone_in": ["9876543210", "+91 98765 43210", "919876543210"],
    "date_sane": ["14/03/2024", "2024-03-14", "14 March 2024", "Mar 14, 2024"],
    "amount_sane": ["1,234.50", "INR 10", "0"],
    "invoice_number": ["INV-2024-0042", "PO-1234", "BILL-99"],
}
BAD = {
    "pan": ["ABCDE1234F", "AAPFU0939", "AAP1U0939F", "", None],
    "aadhaar": ["269837654321", "26983765432", "069837654322", "169837654322", None],
    "gstin": ["27AAPFU0939F1ZW", "00AAPFU0939F1ZV", "39AAPFU0939F1ZV", "27AAPFU0939F1XV", "27ABCDE1234F1ZV", None],
    "luhn": ["4539578763621487", "18", "0" * 20, None],
    "ifsc": ["HDFC1001234", "HDFC000123", None],
    "email": ["ab.co", "a@@b.co", "a@b", "a..b@c.de", "@b.co", "a@.co", None],
    "phone_in": ["1234567890", "98765", None],
    "date_sane": ["31/02/2024", "14/03/1989", "soon", None],
    "amount_sane": ["-5", "abc", "1.2.3", None],
    "invoice_number": ["INVOICE", "A1", "", None],
}


@pytest.mark.parametrize("name", sorted(GOOD))
def test_validators(spark, name):
    assert each(spark, GOOD[name], lambda v: validators.validate(name, v)) == [True] * len(GOOD[name])
    assert each(spark, BAD[name], lambda v: validators.validate(name, v)) == [False] * len(BAD[name])


def test_unknown_validator_is_false(spark):
    assert each(spark, ["x"], lambda v: validators.validate("nothing", v)) == [False]


def test_verhoeff_sees_every_digit_error_and_swap(spark):
    payload = ["26983765432", "99999999999", "12345678901"]
    digits = each(spark, payload, validators.verhoeff_digit)
    whole = [p + d for p, d in zip(payload, digits)]
    assert each(spark, whole, validators.verhoeff) == [True] * 3
    wrong = [w[:i] + str(d) + w[i + 1 :] for w in whole for i in range(12) for d in range(10) if str(d) != w[i]]
    wrong += [w[:i] + w[i + 1] + w[i] + w[i + 2 :] for w in whole for i in range(11) if w[i] != w[i + 1]]
    assert not any(each(spark, wrong, validators.verhoeff))


def test_every_other_gstin_digit_fails(spark):
    others = ["27AAPFU0939F1Z" + c for c in "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ" if c != "V"]
    assert not any(each(spark, others, validators.gstin))


def test_dates(spark):
    values = ["14/03/2024", "03/14/2024", "1-2-69", "1-2-70", "2024-3-5", "14 Mar, 2024", "March 14 2024", "30/02/2024", "14 Foo 2024", "", None, "32/13/2024"]
    assert each(spark, values, normalizers.date_iso) == ["2024-03-14", "2024-03-14", "2069-02-01", "1970-02-01", "2024-03-05", "2024-03-14", "2024-03-14", None, None, None, None, None]
    assert each(spark, ["03/04/2024"], lambda v: normalizers.date_iso(v, dayfirst=False)) == ["2024-03-04"]


def test_normal_forms(spark):
    form = normalizers.normalize
    assert each(spark, ["12.345", "12.355", "1,234", "abc", "1.2.3", None], lambda v: form("currency", v)) == ["12.34", "12.36", "1234.00", None, None, None]
    assert each(spark, [" ab-c d"], lambda v: form("id_upper", v)) == ["ABCD"]
    assert each(spark, ["\t A\n b "], lambda v: form("upper_strip", v)) == ["A B"]
    assert each(spark, [" aB "], lambda v: form("lower_strip", v)) == ["ab"]
    assert each(spark, ["x"], lambda v: form(None, v)) == ["x"] and each(spark, ["x"], lambda v: form("other", v)) == ["x"]
    assert each(spark, ["Total Rs. 5", "Total $5", "Total 5"], lambda v: normalizers.currency_code(v, F.char_length(v) - 1)) == ["INR", "USD", "INR"]


def test_canonical_text_and_pages(spark):
    pages = [["a", "", "bé\U0001f600"], ["x"], []]
    rows = spark.createDataFrame([(p,) for p in pages], "p array<string>").select("p", canonical_text(F.col("p")).alias("t"), page_spans(F.col("p")).alias("s"))
    for r in rows.collect():
        assert r.t == PAGE_SEP.join(r.p) and [r.t[s.start : s.end] for s in r.s] == r.p
    at = spark.createDataFrame([(["ab", "cd"], o) for o in range(8)], "p array<string>, o int").select("o", page_of(page_spans(F.col("p")), F.col("o")).alias("n"))
    assert {r.o: r.n for r in at.collect()} == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1}


def test_text_helpers(spark):
    assert each(spark, ["a\r\nb\rc\fd"], sanitize) == ["a\nb\nc\nd"]
    assert each(spark, ["a\r\nb\f"], sanitize_fixed_width) == ["a\n\nb\n"]
    assert each(spark, ["  a \n b" + "x" * 300], preview)[0] == ("a b" + "x" * 300)[:200]
    scores = F.create_map(F.lit("b"), F.lit(0.4), F.lit("a"), F.lit(0.4), F.lit("c"), F.lit(0.9))
    assert spark.range(1).select(runner_up(scores, F.lit("c")).alias("x")).first().x == ("a", 0.4)


def test_quality(spark):
    clean, corrupt = "The quick brown fox jumps over the lazy dog near the river bank", "lnvoice n0mber tOtaL lbs 4mount dUe pAymEnt lcgal d0c"
    a, b, none, other = each(spark, [clean, corrupt, "", "日本語 テキスト"], quality.score_text)
    assert a.score == 0 and b.score > 0.5 and none.tokens == 0 and other.non_latin_rate == 1.0 and other.score == 0
    assert each(spark, [corrupt, clean], lambda v: quality.prefer_ocr(v, F.lit(clean))) == [True, False]
    methods = [["native"], ["ocr", "ocr_rescued"], ["native", "ocr"], ["none"], []]
    rows = spark.createDataFrame([(i, m) for i, m in enumerate(methods)], "n int, m array<string>").select("n", quality.document_method(F.col("m")).alias("x"))
    assert [r.x for r in sorted(rows.collect())] == ["native", "ocr", "hybrid", "none", "none"]


def test_case_shape(spark):
    tokens = ["Hello", "HELLO", "hello", "hELLo", "A.b", "ab", "O'Neil"]
    assert each(spark, tokens, quality.badly_cased) == [False, False, False, True, False, False, True]


def test_orders_do_not_matter(spark):
    rng = random.Random(0)
    values = list(itertools.chain(*GOOD.values()))
    shuffled = values[:]
    rng.shuffle(shuffled)
    a = dict(zip(values, each(spark, values, validators.luhn)))
    assert a == dict(zip(shuffled, each(spark, shuffled, validators.luhn)))
