from pyspark.sql import functions as F

from holdwright.api import Portfolio
from holdwright.functions import credit, rates, rows


def test_row_checks(spark):
    df = spark.createDataFrame(
        [(1, "Acme Inc (Revolver)", "First Lien", 4040.0, 4000.0, 4.0), (2, "Total investments", "", None, None, 9.0), (3, "12.5%", "Common stock", 1.0, 2.0, 3.0), (4, "| a | b |", "Warrants", 2000.0, 13.0, 1990.0)],
        "i int, company_name string, investment_type string, p double, c double, v double",
    )
    got = {r.i: r for r in df.select("i", rows.is_company().alias("ok"), rows.is_debt().alias("debt"), rows.is_artifact().alias("art"), rows.flags(F.col("p"), F.col("c"), F.col("v"), F.col("company_name"), F.col("investment_type")).alias("f")).collect()}
    assert [got[i].ok for i in (1, 2, 3, 4)] == [True, False, False, True]
    assert [got[i].debt for i in (1, 3, 4)] == [True, False, False] and got[4].art
    assert got[1].f == ["fair_value_suspicious_vs_size", "type_hint_revolver_from_name"] and got[4].f == ["cost_suspicious_vs_size"]
    m = spark.createDataFrame([("b| a ",), (None,)], "x string").select(rows.merge_flags(F.col("x"), F.array(F.lit("a"), F.lit("c"))).alias("m")).collect()
    assert [x.m for x in m] == ["a|b|c", "a|c"]


def test_row_kinds(spark):
    cases = [(["", " "], "blank"), (["Total debt", "5"], "total"), (["Software - 12.3%"], "section"), (["Acme", "SOFR", "5,000"], "company"), (["", "5,000", "$ 4"], "values"), (["", "Term Loan", "5"], "continued")]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, c array<string>")
    assert [r.k for r in df.orderBy("i").select(rows.row_kind(F.col("c")).alias("k")).collect()] == [k for _, k in cases]


def test_rate_cells(spark):
    cases = [
        ("SOFR + 4.25% / 2% PIK", ("SOFR", 4.25, None, 2.0, None)), ("6-month LIBOR + 7.5%, Floor 1.25%", ("LIBOR", 7.5, 1.25, None, None)), ("E+ 650, 0.75% EURIBOR floor", ("Euribor", 6.5, 0.75, None, None)),
        ("Prime - 0.4%", ("Prime", -0.4, None, None, None)), ("11.25%", (None, None, None, None, 11.25)), ("variable", (None, None, None, None, None)), ("L (Q) + 6%", ("LIBOR", 6.0, None, None, None)),
        ("9% PIK", (None, None, None, 9.0, None)), ("10.5% / 3% PIK", (None, None, None, 3.0, 10.5)), ("SOFR + 6% (floor of 2%)", ("SOFR", 6.0, 2.0, None, None)), (None, (None, None, None, None, None)),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, c string")
    for r, (c, want) in zip(df.orderBy("i").select(rates.parse(F.col("c")).alias("r")).collect(), cases, strict=True):
        assert tuple(r.r) == want, c


def test_credit(spark):
    cases = [
        ("At 30 June 2025, five issuers were on non-accrual. Non-accrual assets stood at 2.2% and 3.1% of all loans at fair value and amortized cost. The average risk rating was 1.9.", (3.1, 2.2, 5, 1.9, "high")),
        ("Non-accrual loans made up 6.5% of the book at cost. Nothing else, 9% fair value.", (6.5, None, None, None, "medium")),
        ("Fees other than non-accrual loans were 5.5% at cost.", (None, None, None, None, "none")),
        ("On non-accrual: 1.5% at cost and 2.5% at fair value.", (None, 2.5, None, None, "medium")),
        ("Non-accrual loans were 55% at cost. 12 companies were on non-accrual.", (None, None, 12, None, "none")),
        (None, (None, None, None, None, "none")),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, c string")
    for r, (c, want) in zip(df.orderBy("i").select(credit.extract(F.col("c")).alias("r")).collect(), cases, strict=True):
        assert tuple(r.r) == want, c


def test_portfolio(spark):
    h = spark.createDataFrame(
        [("AA", "2024-03-31", "x", "loan", 5.0), ("AA", "2024-06-30", "x", "loan", 6.0), ("AA", "2024-06-30", "y", "note", 4.0), ("BB", "2024-06-30", "z", "loan", 1.0)],
        "ticker string, d string, company_name string, kind string, fair_value double",
    ).withColumn("filing_date", F.to_date("d"))
    p = Portfolio(h, credit=h)
    assert p.tickers().count() == 2 and p.holdings("aa").count() == 2 and p.periods("AA").count() == 2
    assert {(r.company_name, r.status) for r in p.changes("AA", "2024-03-31", "2024-06-30").collect()} == {("x", "Increased"), ("y", "Added")}
    assert p.slice("AA", None, F.col("kind") == "note").first().pct == 40.0
    assert p.search("Y", ["company_name"]).count() == 1 and p.table("credit", "BB").count() == 1
    assert p.mix("AA", "kind").count() == 3 and p.history("AA").count() == 2 and p.freshness().first().tickers == 2
    assert {r.ticker: r.score for r in p.scorecard({"fv": F.sum("fair_value")}).collect()} == {"AA": 100.0, "BB": 0.0}
