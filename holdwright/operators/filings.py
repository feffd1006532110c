"""Rows of filings: cleaning as one projection, tables to leave out, columns by their heads, rows of other sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names, parse, text
from . import dedup

# Phrases of tables that are no schedule. A table is one if of every group of a line it holds one.
OTHER_TABLES = [
    [["cash flows from operating activities"], ["net cash provided by"]],
    [["net cash provided by (used for) operating activities"]],
    [
        ["net change in unrealized appreciation", "net change in unrealized depreciation"],
        ["for the three months ended"],
        ["for the nine months ended"],
        ["($ in millions)", "portfolio company"],
    ],
    [["level 1"], ["level 2"], ["level 3"]],
    [["purchases"], ["sales or payoffs", "pay-offs"], ["beginning of period", "end of period"]],
]


def standardize(df: DataFrame, company: str = "company_name", kind: str = "investment_type", industry: str = "industry", rate: str = "reference_rate", spread: str = "spread") -> DataFrame:
    """A holdings row with its names in standard form, in one projection, and ``changed``: how many of them that altered.

    The sector is the row's own, else what the company's name tells.
    """
    cleaned = df.withColumn("__c", names.clean_company(F.col(company)))
    new = {
        industry: names.industry_of(F.col(industry), F.col("__c.industry"), F.col("__c.name")),
        kind: text.instrument_type(F.col(kind)),
        rate: text.reference_rate(F.col(rate)),
        spread: text.clean_spread(F.col(spread)),
        company: F.col("__c.name"),
    }
    changed = sum((F.when(F.coalesce(F.col(c), F.lit("")).eqNullSafe(e), 0).otherwise(1) for c, e in new.items()), F.lit(0))
    return cleaned.withColumns({**new, "changed": changed}).drop("__c")


def is_other_table(t: Column) -> Column:
    """Tables that name investments but are no schedule: cash flows, changes in unrealized value, levels, roll-forwards."""
    return F.coalesce(text.holds(F.lower(t), OTHER_TABLES), F.lit(False))


def is_prior_year_table(t: Column, period: Column) -> Column:
    """A table that tells 31 December of an earlier year and nowhere its own period's end.

    After ``as of`` or ``at`` the period's date always counts; alone it does unless it is 31 December, when
    loans mature. The period is looked for in the first 8000 letters, the earlier year in 2500.
    """
    low = F.regexp_replace(F.lower(t), "[ –—]", " ")
    month, day, year = F.lower(F.date_format(period, "MMMM")), F.dayofmonth(period).cast("string"), F.year(period).cast("string")
    told = F.concat(month, F.lit(r"\s+"), day, F.lit(r"[,\s]+"), year)
    head = F.substring(low, 1, 8000)
    as_of = F.regexp_like(head, F.concat(F.lit(r"(as\s+of|at)\s+"), told))
    short = F.concat(F.substring(month, 1, 3), F.lit(r"\.?\s+"), day, F.lit(r"[,\s]+"), year)
    numeric = F.concat(F.lit(r"\b0?"), F.month(period).cast("string"), F.lit("/0?"), day, F.lit("/"), year, F.lit(r"\b"))
    bare = F.regexp_like(head, F.concat_ws("|", told, short, numeric, F.concat(F.lit(r"\b"), F.date_format(period, "yyyy-MM-dd"), F.lit(r"\b"))))
    current = as_of | (bare & ~((F.month(period) == 12) & (F.dayofmonth(period) == 31)))
    first = F.substring(low, 1, 2500)
    earlier = lambda p: F.coalesce(F.regexp_extract(first, p, 1).try_cast("int") < F.year(period), F.lit(False))
    return ~F.coalesce(current, F.lit(False)) & (earlier(r"(?:december|dec\.?)\s+31[,\s]+(\d{4})") | earlier(r"\b12[/-]31[/-](\d{4})\b"))


def money_cells(cells: Column) -> Column:
    """struct(principal, cost, fair_value): the last three numbers of a row of cells; with two there is no principal, one is a value.

    Signs of currency, their codes, shares and blanks don't count; a dash is zero.
    """
    plain = F.transform(cells, lambda c: F.trim(F.coalesce(c, F.lit(""))))
    kept = F.filter(plain, lambda c: ~c.rlike(r"(?i)^(|\$|€|£|usd|eur|gbp|cad|aud|chf|sek|nok|dkk|jpy|%)$") & ~c.endswith("%"))
    numbers = F.filter(F.transform(kept, lambda c: F.when(c.rlike("^[-–—]$"), 0.0).otherwise(parse.to_double(c))), lambda x: x.isNotNull())
    return text.let(numbers, lambda n: F.struct(*[F.try_element_at(n, F.lit(-k)).alias(name) for k, name in ((3, "principal"), (2, "cost"), (1, "fair_value"))]))


# Spellings of a maturity that fill a cell.
MATURITY = r"(?i)^(\d{1,2}/\d{1,2}/\d{4}|\d{1,2}[/-]\d{4}|\d{4}-\d{2}-\d{2}|n/?a|(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*[\s-]\d{4})$"


def around_maturity(cells: Column) -> Column:
    """struct(rate, maturity, principal, cost, fair_value) of a row of cells behind its name: what stands before the first
    cell that is a maturity tells the rate (filled cells, in order), what stands behind it is money.

    ``n/a`` is a maturity without a date, and a month is its first day. Without any maturity all cells are of the rate and there is no money.
    """
    plain = F.transform(cells, lambda c: F.trim(F.coalesce(c, F.lit(""))))
    place = lambda p: F.try_element_at(F.filter(F.transform(p, lambda c, i: F.when(c.rlike(MATURITY), i + 1)), lambda i: i.isNotNull()), F.lit(1))
    return text.let(plain, lambda p: text.let(place(p), lambda at: _around(p, at)))


def _around(plain: Column, at: Column) -> Column:
    def date(told: Column) -> Column:
        month = F.regexp_extract(told, r"^([A-Za-z]{3})[A-Za-z]*[\s-](\d{4})$", 0)
        first = lambda m: F.when(m != "", F.concat(F.initcap(F.substring(m, 1, 3)), F.lit(" "), F.right(m, F.lit(4)), F.lit(" 01")))
        named = F.date_format(F.try_to_date(text.let(month, first), "MMM yyyy dd"), "yyyy-MM-dd")
        return F.when(told.rlike("(?i)^n/?a$"), None).otherwise(F.coalesce(named, parse.normalize_date(told)))

    before = F.slice(plain, 1, F.coalesce(at - 1, F.size(plain)))
    behind = F.when(at.isNotNull() & (at < F.size(plain)), F.slice(plain, at + 1, F.greatest(F.size(plain) - at, F.lit(0)))).otherwise(F.array().cast("array<string>"))
    one = lambda r: F.struct(F.filter(before, lambda c: c != "").alias("rate"), text.let(F.try_element_at(plain, at), date).alias("maturity"), *[r[n].alias(n) for n in ("principal", "cost", "fair_value")])
    return text.let(money_cells(behind), one)


def drop_sparse_twins(df: DataFrame, keys: Sequence[str], fields: Sequence[str], seq: str, sparse: int = 5) -> DataFrame:
    """Rows of one key (company and value): those with at most ``sparse`` fields go where a richer row, or an equal one before them, is there.

    A key's best row is a struct minimum, which combines before the shuffle; only sparse rows meet it, in a join that Spark can split.
    """
    d = df.withColumn("__n", dedup.populated(fields))
    best = d.groupBy(*keys).agg(F.min(F.struct(-F.col("__n"), F.col(seq)))[seq].alias("__best"))
    best = best.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__best")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    kept = d.filter(F.col("__n") <= sparse).join(best, same & (F.col(seq) == F.col("__best")), "left_semi")
    return d.filter(F.col("__n") > sparse).unionByName(kept).drop("__n")


def drop_repeated_schedules(df: DataFrame, filing: Sequence[str], table: str, place: str, name: str, first: int = 5, least: int = 3) -> DataFrame:
    """Without the tables of a filing whose first names are those of an earlier table; tables with fewer than ``least`` names stay.

    Only the first names of each table are gathered.
    """
    head = df.filter(F.col(place) <= first).groupBy(*filing, table)
    head = head.agg(F.transform(F.array_sort(F.collect_list(F.struct(place, F.lower(name).alias("n")))), lambda x: x["n"]).alias("__sig"))
    same = head.filter(F.size("__sig") >= least).withColumn("__first", F.min(table).over(Window.partitionBy(*filing, "__sig")))
    gone = same.filter(F.col(table) > F.col("__first")).select(*filing, table)
    return df.join(gone, [*filing, table], "left_anti")


def with_company_id(rows: DataFrame, name: str, index: DataFrame) -> DataFrame:
    """company_id of each row: that of its name in index (name, company_id), else of its cleaned name, else of a hash of the cleaned name; blank names have none.

    A name that the index has under several ids has the least of them.
    """
    index = index.groupBy("name").agg(F.min("company_id").alias("company_id"))
    raw = index.select(F.col("name").alias("__raw"), F.col("company_id").alias("__by_raw"))
    clean = index.select(F.col("name").alias("__clean"), F.col("company_id").alias("__by_clean"))
    d = rows.withColumn("__raw", F.trim(name)).withColumn("__clean", names.clean_company(F.col(name))["name"])
    d = d.join(raw, "__raw", "left").join(clean, "__clean", "left")
    found = F.coalesce("__by_raw", "__by_clean", text.stable_id(F.col("__clean")))
    return d.withColumn("company_id", F.when(text.blank(F.col(name)), "").otherwise(found)).drop("__raw", "__clean", "__by_raw", "__by_clean")


def merge_canonical(name: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """Names that a person has said are one company: canonical name by its spellings."""
    pairs = [F.lit(x) for target, some in groups.items() for spelling in some for x in (spelling, target)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), name) if pairs else name


def enrich(rows: DataFrame, other: DataFrame, keys: Sequence[str], value: str, fields: Sequence[str]) -> DataFrame:
    """Blank fields from another source: of the row with the same keys and value, else the first known of the same keys."""
    exact = other.groupBy(*keys, value).agg(*[F.min(c).alias(f"__v_{c}") for c in fields])
    loose = other.groupBy(*keys).agg(*[F.min(c).alias(f"__k_{c}") for c in fields])
    d = rows.join(exact, [*keys, value], "left").join(loose, list(keys), "left")
    full = lambda c: F.when(F.trim(F.col(c).cast("string")) != "", F.col(c))
    return d.withColumns({c: F.coalesce(full(c), F.col(f"__v_{c}"), F.col(f"__k_{c}")) for c in fields}).select(*rows.columns)


def period_of(instant: Column, end: Column, filed: Column) -> Column:
    """struct(end, type) of a statement's row: its instant, else the end of its duration, else the filing date."""
    kind = F.when(instant.isNotNull(), "instant").when(end.isNotNull(), "duration").otherwise("filing")
    return F.struct(F.coalesce(instant, end, filed).alias("end"), kind.alias("type"))


def metric_key(label: Column, aliases: Mapping[str, Sequence[str]]) -> Column:
    """The metric whose aliases include a statement line's label, case and spaces aside; null if none do."""
    pairs = [F.lit(x) for key, some in aliases.items() for alias in some for x in (" ".join(alias.lower().split()), key)]
    return F.try_element_at(F.create_map(*pairs), F.trim(F.regexp_replace(F.lower(label), r"\s+", " ")))
