"""Quality of what was read: joins beside reported figures, grades, facts as columns, columns of tables, profiles, reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse, rates, text
from . import dedup
from .aggregate import ranked

# Concepts (lower-cased) by the column that they fill.
FACT_NAMES = {
    "cost": ["investmentatcost", "investmentownedatcost"],
    "cash_rate": [
        "investmentinterestrate", "investmentinterestratecash", "investmentinterestratecontractual", "investmentinterestrateeffective",
        "investmentinterestratepaidincash", "investmentinterestrateduringperiod",
    ],
    "spread": ["investmentinterestratespread"],
    "reference_rate": ["investmentvariableinterestratetypeextensibleenumeration"],
    "rate_cap": ["investmentinterestratecap"],
    "shares": ["investmentownedbalanceshares"],
    "acquisition_date": ["investmentacquisitiondate"],
    "maturity_date": ["investmentmaturitydate"],
}
# Concepts that fill a column which nothing else fills; the first of them counts.
FALLBACK_NAMES = {
    "cash_rate": ["investmentowneddividendrate", "investmentestimatedyield", "investmentcompanyreturnrate", "investmentinterestrateterms"],
    "reference_rate": ["investmentvariableinterestratetype"],
}
# Parts of other concepts by column, in order; of every group a concept has one.
FACT_PARTS = [
    ("fair_value", [["fairvalue"], ["investment"]]),
    ("amortized_cost", [["amortizedcost"]]),
    ("principal_amount", [["principalamount", "balanceprincipal"]]),
    ("pik_rate", [["pik", "paidinkind"], ["rate"]]),
    ("floor_rate", [["interestratefloor"]]),
    ("spread", [["basisspread", "spreadovervariable"]]),
    ("percent_of_net_assets", [["percentofnetassets", "percentageofnetassets"]]),
    ("undrawn_commitment", [["unfunded"], ["commitment"]]),
    ("commitment_limit", [["commitment"]]),
]
FACT_COLUMNS = [
    "fair_value", "amortized_cost", "cost", "principal_amount", "pik_rate", "cash_rate", "floor_rate", "spread", "reference_rate", "rate_cap", "shares",
    "percent_of_net_assets", "acquisition_date", "maturity_date", "undrawn_commitment", "commitment_limit",
]
MONEY = ["fair_value", "amortized_cost", "cost", "principal_amount", "undrawn_commitment", "commitment_limit"]
RATES = ["pik_rate", "cash_rate", "floor_rate", "spread", "rate_cap", "percent_of_net_assets"]
# Parts of names that are no company's.
NO_COMPANIES = [
    "sub total", "subtotal", "total investments", "total portfolio", "investment non-affiliated issuer", "non-affiliate", "non-control", "senior secured loans", "equity interests",
    "equity/warrants", "equipment financing", "first lien bank debt",
]


def quality_periods(recon: DataFrame, flags: DataFrame, filings: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Reconciled periods with their flags (none: empty) and the form and url of the filing of that date; each side has one row a key."""
    on = [*keys, date]
    d = recon.join(flags.select(*on, "quality_flags"), on, "left").join(filings.select(*on, "form", "url"), on, "left")
    return d.withColumn("quality_flags", F.coalesce("quality_flags", F.lit("")))


def beside_portfolio(series: DataFrame, periods: DataFrame, keys: Sequence[str], end: str, filed: str, value: str, flags: str) -> DataFrame:
    """A metric's series with the portfolio's value and number of flags at each end; of several filings with one end the last counts, for the value the last that has one."""
    last = periods.groupBy(*keys, end).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(filed))).alias("portfolio"), F.max_by(flags, filed).alias("flag_count"))
    return series.join(last, [*keys, end], "left")


def audit(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: rows, companies, value in millions, share of valued rows with cost and with a rate (whole per cent, halves to even), and a grade.

    A: 40 per cent with a rate and 60 with cost; B: 60 with cost; else C.
    """
    has = lambda *c: F.coalesce(*[F.when(~text.blank(F.col(x).cast("string")), 1) for x in c], F.lit(0)) == 1
    fv = F.coalesce(parse.to_double(F.col("fair_value").cast("string")), F.lit(0.0))
    company = F.upper(F.trim("company_name"))
    g = rows.withColumn("__v", fv != 0).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(F.when(company != "", company)).alias("companies"), (F.sum(fv.cast("decimal(38,4)")).cast("double") / 1000).alias("fv_millions"),
        F.greatest(F.count_if("__v"), F.lit(1)).alias("__n"), F.count_if(F.col("__v") & has("amortized_cost", "cost")).alias("has_cost"), F.count_if(F.col("__v") & has("cash_rate")).alias("has_rate"),
    )
    pct = lambda c: F.bround(F.col(c) * 100 / F.col("__n"), 0).cast("long")
    g = g.withColumns({"cost_pct": pct("has_cost"), "rate_pct": pct("has_rate")})
    grade = F.when((F.col("rate_pct") >= 40) & (F.col("cost_pct") >= 60), "A").when(F.col("cost_pct") >= 60, "B").otherwise("C")
    return g.withColumn("grade", grade).drop("__n")


def name_of_dimension(dim: Column) -> Column:
    """The company in a dimension's text: before the first bar or comma, behind a heading there; without a trailing number."""
    bars, commas = F.transform(F.split(dim, r"\|"), lambda x: F.trim(x)), F.transform(F.split(dim, ",", 4), lambda x: F.trim(x))
    at = lambda a, k: F.try_element_at(a, F.lit(k))
    first = at(bars, 1)
    second = F.when(first.isin("Common Equity/Equity Interests/Warrants", "Equipment Financing"), at(bars, 2)).when((first == "Senior Secured Loans") & (F.size(bars) >= 3), at(bars, 3)).otherwise(first)
    kind = at(commas, 1).rlike(r"(?i)^(DEBT|EQUITY|PREFERRED|WARRANT|COMMON)\s+Investment$") & (F.size(commas) >= 3)
    name = F.when(dim.contains("|"), second).when(dim.contains(","), F.when(kind, at(commas, 3)).otherwise(at(commas, 1))).otherwise(F.trim(dim))
    return F.regexp_replace(name, r"\s+\d+\s*$", "")


def drop_sparse_dimensions(facts: DataFrame, keys: Sequence[str], dim: str, concept: str, detail: str) -> DataFrame:
    """Facts without the dimensions that have no detail (a concept that matches ``detail``) where the same company, whatever its case, has one with detail.

    Dimensions and companies are aggregated before they meet.
    """
    name = F.upper(F.trim(name_of_dimension(F.col(dim))))
    dims = facts.groupBy(*keys, dim).agg(F.bool_or(F.coalesce(F.lower(F.col(concept)).rlike(detail), F.lit(False))).alias("__rich")).withColumn("__name", name)
    rich = dims.filter(F.col("__rich") & (F.col("__name") != "")).select(*keys, "__name").distinct()
    gone = dims.filter(~F.col("__rich")).join(rich, [*keys, "__name"], "left_semi").select(*keys, dim)
    return facts.join(gone, [*keys, dim], "left_anti")


def _column_of(concept: Column, names: Mapping[str, Sequence[str]]) -> Column:
    pairs = [F.lit(x) for column, some in names.items() for name in some for x in (name, column)]
    return F.try_element_at(F.create_map(*pairs), concept)


def fact_columns(facts: DataFrame, keys: Sequence[str], concept: str, value: str, seq: str, divisor: Column | None = None) -> DataFrame:
    """A row per key (a position's dimension) with a text column for each of FACT_COLUMNS; of several facts of a column the last by seq counts.

    Money is divided by divisor, rates become percentages, a missing cost is the other cost, a spread without a
    rate's name is over SOFR, and the type tells debt (principal or spread) from shares. Absent facts are null.
    """
    low = F.lower(F.col(concept))
    x = parse.to_double(F.col(value))
    parts = None
    for column, groups in FACT_PARTS:
        parts = F.when(text.holds(low, [groups]), column) if parts is None else parts.when(text.holds(low, [groups]), column)
    late = _column_of(low, FALLBACK_NAMES)
    field = F.coalesce(_column_of(low, FACT_NAMES), late, parts)
    zero = (low == "investmentinterestrateduringperiod") & (F.coalesce(x, F.lit(0.0)) == 0)
    money = parse.number_text(x / (F.lit(1.0) if divisor is None else divisor))
    shown = F.when(field.isin(MONEY), money)
    shown = shown.when(low == "investmentinterestrateterms", rates.of_terms(F.col(value)))
    shown = shown.when(field.isin(RATES), parse.number_text(parse.fraction_to_percent(x)))
    shown = shown.when(low == "investmentvariableinterestratetypeextensibleenumeration", text.rate_of_url(F.col(value))).otherwise(F.trim(value))
    d = facts.select(*keys, F.col(seq).alias("__seq"), field.alias("__f"), late.isNotNull().alias("__late"), F.when(~zero & (shown != ""), shown).alias("__v")).filter("__f is not null and __v is not null")
    of = lambda c, late: F.when((F.col("__f") == c) & (F.col("__late") == late), F.col("__seq"))
    known = lambda c: F.max_by("__v", of(c, False))
    wide = d.groupBy(*keys).agg(*[(F.coalesce(known(c), F.min_by("__v", of(c, True))) if c in FALLBACK_NAMES else known(c)).alias(c) for c in FACT_COLUMNS])
    both = {"cost": F.coalesce("cost", "amortized_cost"), "amortized_cost": F.coalesce("amortized_cost", "cost")}
    wide = wide.withColumns({**both, "reference_rate": F.coalesce("reference_rate", F.when(F.col("spread").isNotNull(), "SOFR"))})
    kind = F.when(F.col("principal_amount").isNotNull() | F.col("spread").isNotNull(), "First Lien").when(F.col("shares").isNotNull(), "Other Equity").otherwise("Other")
    return wide.withColumn("investment_type", kind)


def leading_companies(exposures: DataFrame, limit: int = 10, least_funds: int = 2) -> DataFrame:
    """(company_id, canonical_name) of the largest exposures of enough funds, without headings and subtotals; ties by id."""
    name = F.coalesce(F.when(~text.blank(F.col("company_name")), F.trim("company_name")), F.col("company_id"))
    ok = F.col("company_id").startswith("co_") & (F.coalesce("funds", F.lit(0)) >= least_funds)
    for part in NO_COMPANIES:
        ok = ok & ~F.lower(name).contains(part)
    top = exposures.withColumn("__name", name).filter(ok).orderBy(F.desc(F.coalesce("exposure_m", F.lit(0.0))), "company_id").limit(limit)
    return top.select("company_id", F.col("__name").alias("canonical_name"))


def profiles_due(companies: DataFrame, profiles: DataFrame, now: Column, empty_only: bool = False, days: int = 30) -> DataFrame:
    """Companies without a profile, or with one of ``days`` days or more (no date: due); empty_only: with one that has no description."""
    p = profiles.select("company_id", F.col("updated_at").alias("__at"), F.col("description").alias("__text"), F.lit(True).alias("__has"))
    due = text.blank(F.col("__text")) if empty_only else F.coalesce(F.col("__at").isNull() | (F.datediff(now, "__at") >= days), F.lit(True))
    return companies.join(p, "company_id", "left").filter(F.col("__has").isNull() | due).drop("__at", "__text", "__has")


def skeletons(companies: DataFrame, industry: str, allowed: Sequence[str]) -> DataFrame:
    """A profile from what the filings tell: the industry in standard form, Other where it isn't an allowed one."""
    own = F.coalesce(F.trim(industry), F.lit(""))
    standard = text.sector(own)
    return companies.select("company_id", "canonical_name", own.alias("industry_initial"), F.when(own == "", "").when((standard == "") | standard.isin(*allowed), standard).otherwise("Other").alias("industry"), F.lit("skeleton").alias("source"))


def profile_industry(exposures: DataFrame, profiles: DataFrame, industry: str) -> DataFrame:
    """exposures with the industry of a company's profile, in standard form, where it has one."""
    p = profiles.select("company_id", text.sector(F.trim("industry")).alias("__told"))
    d = exposures.join(p, "company_id", "left")
    return d.withColumn(industry, F.coalesce(F.when(F.col("__told") != "", F.col("__told")), F.col(industry))).drop("__told")


def holding_report(rows: DataFrame, keys: Sequence[str], percent: str, *ties: str, k: int = 10, large: float = 15.0) -> DataFrame:
    """A filing's k largest holdings by share of net assets and all above ``large``: rank and is_large. Shares that are null count as 0."""
    p = F.coalesce(F.col(percent), F.lit(0.0))
    r = ranked(rows, keys, F.desc(p), *[F.asc(t) for t in ties], name="rank")
    return r.withColumn("is_large", p > large).filter((F.col("rank") <= k) | F.col("is_large"))


def drop_dominated(labels: DataFrame, keys: Sequence[str], label: str, most: float = 0.7) -> DataFrame:
    """Without the labels of keys in which one label has more than ``most`` of all."""
    n = labels.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("__c")).groupBy(*keys).agg((F.max("__c") / F.sum("__c")).alias("__top"))
    return labels.join(n.filter(F.col("__top") > most).select(*keys), list(keys), "left_anti")


# Orders of a difference's rows, by name.
ORDERS = {
    "delta_abs": lambda: F.desc(F.abs(F.col("delta"))), "delta_desc": lambda: F.desc("delta"), "delta_asc": lambda: F.asc("delta"), "name": lambda: F.asc("name"),
    "fv": lambda: F.desc(F.coalesce("after", "before")), "positions": lambda: F.desc(F.coalesce("positions_after", "positions_before")), "changed": lambda: F.desc("changed"),
}


def sorted_changes(changes: DataFrame, mode: str = "delta_abs") -> DataFrame:
    """A difference's rows in one of ORDERS, then by name; an unknown mode is delta_abs."""
    return changes.orderBy(ORDERS.get(mode, ORDERS["delta_abs"])(), "name")


def statement_file(path: Column) -> Column:
    """struct(ticker, date, type) of ``TICKER_YYYY-MM-DD[_10-K]_balance_sheet.csv`` or ``income_statement``; null for other files."""
    p = r"^([A-Z0-9]+)_(\d{4}-\d{2}-\d{2})(?:_10-K)?_(balance_sheet|income_statement)\.csv$"
    f = F.substring_index(path, "/", -1)
    part = lambda k: F.regexp_extract(f, p, k)
    return F.when(f.rlike(p), F.struct(part(1).alias("ticker"), part(2).alias("date"), part(3).alias("type")))


def instance_documents(documents: DataFrame, keys: Sequence[str], file: str, seq: str) -> DataFrame:
    """The first document of each filing that is an instance: XML or an XBRL page, no schema and no link base."""
    low = F.lower(F.col(file))
    ok = low.rlike(r"\.xml|xbrl\.html?") & ~low.rlike(r"schema|(cal|def|lab|pre)\.xml|calculation|definition|label|presentation")
    return dedup.keep_best(documents.filter(ok), keys, F.col(seq))


def text_before(html: Column, pos: Column, letters: int = 500) -> Column:
    """The last letters of a page's text before a position, without tags, white space squeezed."""
    t = F.trim(F.regexp_replace(F.regexp_replace(F.substring(html, F.lit(1), pos.cast("int")), r"<[^>]+>", " "), r"\s+", " "))
    return F.when(F.length(t) > letters, F.right(t, F.lit(letters))).otherwise(t)
