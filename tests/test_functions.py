import datetime

import pytest
from pyspark.sql import functions as F

from holdwright.functions import names, parse, rates, text


def each(spark, f, cases, kind="string"):
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], f"i int, x {kind}")
    got = [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]
    for (x, want), y in zip(cases, got, strict=True):
        assert y == (pytest.approx(want) if isinstance(want, float) else want), (x, want, y)


def test_numbers(spark):
    each(spark, parse.to_double, [("(1,234.5)", -1234.5), (" $ 12% ", 12.0), ("5d", None), ("Infinity", None), ("", None), (None, None), ("-3e2", -300.0), ("(5", 5.0), (".5", 0.5)])
    each(spark, parse.to_double_or_zero, [("x", 0.0), ("7", 7.0)])
    each(spark, parse.first_number, [("$ (1,200) (3)", -1200.0), ("—", None), ("abc 12.5 x", 12.5)])
    each(spark, parse.number_text, [(5.0, "5"), (1234.5, "1234.5"), (0.123456789, "0.123457"), (100.0, "100")], "double")
    each(spark, parse.percent_text, [("6", "6.0%"), ("6.25%", "6.25%"), ("45", None), ("45%", "45.0%"), ("x", None)])
    each(spark, parse.fraction_to_percent, [(0.0625, 6.25), (6.25, 6.25), (625.0, None)], "double")


def test_dates(spark):
    d = datetime.date
    each(spark, parse.parse_date, [("2024-3-31", d(2024, 3, 31)), ("3/31/2024", d(2024, 3, 31)), ("3/4/69", d(1969, 3, 4)), ("3/4/68", d(2068, 3, 4)), ("2024-13-01", None), ("x", None), (None, None)])
    each(spark, parse.normalize_date, [("05/2022", "2022-05-01"), ("5-2022", "2022-05-01"), ("March 3, 2021", "2021-03-03"), ("soon", "soon"), ("1/2/2020", "2020-01-02")])
    each(spark, parse.quarter_end_before, [(d(2024, 3, 31), d(2024, 3, 31)), (d(2024, 3, 30), d(2023, 12, 31)), (d(2024, 1, 1), d(2023, 12, 31))], "date")
    each(spark, parse.quarter_label, [(d(2024, 5, 1), "Q2 2024")], "date")
    each(spark, parse.duration_label, [(90, "Q"), (181, "H1"), (270, "9M"), (365, "FY"), (None, None)], "int")


def test_names(spark):
    each(spark, text.name_key, [("AT&T, Inc.", "at and t inc"), ("  A--B  ", "a b")])
    each(spark, text.without_legal_form, [("Acme Holdings, LLC", "acme"), ("Acme Co., Inc.", "acme"), ("Company", "company"), ("Incline Ltd.", "incline")])
    each(spark, text.block_key, [("Acme, Inc", "acme"), (" The X", "the")])
    each(spark, text.camel_words, [("SeniorSecuredMember", "Senior Secured")])
    each(spark, text.tidy, [("A B – C (1)(2)", "A B - C")])


def test_standards(spark):
    each(spark, text.instrument_type, [("Preferred units", "Preferred Equity"), ("Preferred", "Other"), ("", ""), (None, ""), ("Senior Secured Revolving", "Revolver"), ("DDTL", "Delayed Draw")])
    each(spark, text.reference_rate, [("SOFR (Q)", "SOFR"), ("20240101#SOFRMember", ""), ("x", "x"), ("S+", "SOFR"), ("-", "N/A")])
    each(spark, text.benchmark, [("SOFR", "SOFR"), ("", None), ("Gilt", "Other"), ("Fixed", "Fixed")])
    each(spark, text.sector, [("Oil and Gas", "Energy"), ("Cash", ""), ("Other", ""), ("Zebra", "Zebra")])
    each(spark, text.clean_industry, [("", "Not Reported"), ("Software", "Software")])
    each(spark, text.rate_of_url, [("http://x/y/2024#SoniaMember", "SONIA"), ("nothing", "NOTHING"), ("http://example.org/2024/InvestmentVariableRateType/SOFR", "SOFR"), ("SOFR", "SOFR"), ("x/oneMonthLiborMember", "LIBOR"), ("x#BankBillSwapRateMember", "BBSW"), ("", None), (None, None)])
    each(spark, names.is_rate_token, [("Fed Funds", True), ("ameribor rate", True), ("3-month SARON", False), ("SARON", True), ("gilt", False), ("6 month L", True), (None, False)])
    each(spark, names.instrument_suffix, [("Oak LLC (Revolver)", ("Oak LLC", "Revolver")), ("Oak - Warrants", ("Oak", "Warrants")), ("Oak LLC", ("Oak LLC", None)), (None, (None, None))])
    each(spark, rates.of_terms, [("Fixed rate 7.50%", "7.5%"), ("a fixed interest rate: 8", "8%"), ("SOFR + 3% cash", "3%"), ("S + 4%", ""), ("12% or so", "12%"), ("77%", ""), ("", ""), (None, "")])
    each(spark, text.plain_text, [("<p>5 <b>.</b> 25 <i>%</i> &amp; x</p><script>no</script>", "5.25% & x")])


def test_buckets(spark):
    each(spark, text.spread_bucket, [(2.9, "<3%"), (3.0, "3–4%"), (7.0, "7%+"), (None, None)], "double")
    each(spark, text.age_bucket, [(0.5, "0–1 yrs"), (5.0, "5+ yrs")], "double")
    each(spark, lambda c: text.wall_bucket(c, 2026, 2036), [(2020, "≤2026"), (2030, "2030"), (2036, "2036+"), (None, None)], "int")
    each(spark, lambda c: text.maturity_bucket(c, 2028), [(2027, "2027"), (2030, "2029–2030"), (2035, "2031+"), (2045, "2045")], "int")
