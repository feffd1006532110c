"""Statement facts and filing lists from JSON, as long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FACT = "struct<start:string,end:string,val:double,form:string,filed:string,fy:int,fp:string>"
_PAYLOAD = f"struct<cik:string,entityName:string,facts:map<string,map<string,struct<label:string,units:map<string,array<{_FACT}>>>>>>"
FORMS = ["10-Q", "10-K", "10-Q/A", "10-K/A"]
#: Days of a duration fact: a quarter, a half, nine months, a year.
WINDOWS = [(75, 110), (160, 200), (250, 290), (340, 380)]


def read_company_facts(spark: SparkSession, path: str) -> DataFrame:
    """(cik, entity, namespace, concept, label, unit, start, end, days, val, form, filed, seq) of every file; a file that can't be read gives no rows."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", _PAYLOAD).alias("p"))
    ns = raw.select(F.col("p.cik").alias("cik"), F.col("p.entityName").alias("entity"), F.explode("p.facts").alias("namespace", "concepts"))
    concepts = ns.select("cik", "entity", "namespace", F.explode("concepts").alias("concept", "node"))
    units = concepts.select("cik", "entity", "namespace", "concept", F.col("node.label").alias("label"), F.explode("node.units").alias("unit", "facts"))
    f = units.select("cik", "entity", "namespace", "concept", "label", "unit", F.posexplode("facts").alias("seq", "f"))
    d = {c: F.to_date(F.col(f"f.{c}")) for c in ("start", "end", "filed")}
    f = f.select("cik", "entity", "namespace", "concept", "label", "unit", d["start"].alias("start"), d["end"].alias("end"), F.col("f.val").alias("val"), F.col("f.form").alias("form"), d["filed"].alias("filed"), F.col("seq").cast("long").alias("seq"))
    return f.withColumn("days", F.datediff("end", "start"))


def usable(facts: DataFrame, instant: bool, since: str = "2019-01-01") -> DataFrame:
    """Facts of the periodic forms since a date: instants, or durations of a known length."""
    shape = F.col("start").isNull() if instant else _any_window()
    return facts.filter(F.col("form").isin(FORMS) & (F.col("end") >= F.to_date(F.lit(since))) & shape)


def _any_window() -> Column:
    out = F.lit(False)
    for lo, hi in WINDOWS:
        out = out | F.col("days").between(lo, hi)
    return out


def preferred_namespace(facts: DataFrame) -> DataFrame:
    """Of each company's concept, the facts of us-gaap where it has any, else of the first namespace by name."""
    order = F.struct((F.col("namespace") != "us-gaap").cast("int"), "namespace")
    best = facts.groupBy("cik", "concept").agg(F.min(order).alias("best"))
    return facts.join(best, ["cik", "concept"]).filter(F.col("namespace") == F.col("best.namespace")).drop("best")


def read_filings(spark: SparkSession, path: str, forms: list[str] = FORMS) -> DataFrame:
    """(name, form, filed, report_date, accession, document, seq): the parallel arrays of filing lists as rows."""
    names = {"form": "form", "filingDate": "filed", "reportDate": "report_date", "accessionNumber": "accession", "primaryDocument": "document"}
    recent = ",".join(f"{n}:array<string>" for n in names)
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", f"struct<name:string,filings:struct<recent:struct<{recent}>>>").alias("p"))
    rows = raw.select("p.name", F.posexplode(F.arrays_zip(*[F.col(f"p.filings.recent.{n}").alias(n) for n in names])).alias("seq", "r"))
    rows = rows.select("name", *[F.col(f"r.{n}").alias(to) for n, to in names.items()], F.col("seq").cast("long").alias("seq"))
    return rows.filter(F.col("form").isin(forms)).withColumns({c: F.try_to_date(F.col(c), "yyyy-MM-dd") for c in ("filed", "report_date")})


# Fields of a market quote by part, as the feed names them.
QUOTE = {
    "price": "regularMarketPrice regularMarketChange regularMarketChangePercent regularMarketPreviousClose regularMarketOpen regularMarketDayHigh regularMarketDayLow regularMarketVolume fiftyTwoWeekHigh fiftyTwoWeekLow averageVolume bid ask",
    "summary": "marketCap enterpriseValue trailingPE forwardPE dividendYield dividendRate payoutRatio beta bookValue priceToBook",
    "financial": "totalRevenue revenuePerShare totalCash totalCashPerShare totalDebt currentRatio quickRatio debtToEquity freeCashflow operatingCashflow",
    "shares": "sharesOutstanding sharesShort shortRatio shortPercentOfFloat heldPercentInsiders heldPercentInstitutions",
}


def market_quotes(raw: DataFrame, ticker: str = "ticker", payload: str = "payload") -> DataFrame:
    """(ticker, name, currency, current_price, price, summary, financial, shares) of each quote's JSON; what it lacks, or can't be read, is null.

    The name is the long one, else the short one, else the ticker; the current price is the quote's, else the market's.
    """
    numbers = sorted({n for some in QUOTE.values() for n in some.split()} | {"currentPrice"})
    schema = ",".join(["longName string", "shortName string", "currency string", *[f"{n} double" for n in numbers]])
    q = raw.select(F.col(ticker).alias("ticker"), F.from_json(payload, schema).alias("q"))
    full = lambda c: F.when(F.col(f"q.{c}") != "", F.col(f"q.{c}"))
    return q.select(
        "ticker",
        F.coalesce(full("longName"), full("shortName"), "ticker").alias("name"),
        F.coalesce("q.currency", F.lit("USD")).alias("currency"),
        F.coalesce(F.when(F.col("q.currentPrice") != 0, F.col("q.currentPrice")), "q.regularMarketPrice").alias("current_price"),
        *[F.struct(*[F.col(f"q.{n}") for n in some.split()]).alias(part) for part, some in QUOTE.items()],
    )


def zero_padded_ids(pairs: DataFrame, overrides: DataFrame) -> DataFrame:
    """(ticker, cik) with ten digits; overrides win."""
    pad = lambda d: d.select(F.upper("ticker").alias("ticker"), F.lpad(F.col("cik").cast("string"), 10, "0").alias("cik"))
    o = pad(overrides)
    return pad(pairs).join(o, "ticker", "left_anti").unionByName(o)
