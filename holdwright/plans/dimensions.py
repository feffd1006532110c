"""Dimension strings: cells written from the parts' columns in eight shapes, read back, and names that were cut off."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dimensions, vocab
from .binding import dealt, query

_FORMS = ["LLC", "Inc.", "Corp.", "LP", "Ltd.", "Company", "L.L.C.", "Limited"]
_RATES = ["SOFR", "LIBOR", "Prime", "Euribor", "SONIA", "Base Rate"]


def _of(items, key):
    return F.get(F.array(*[F.lit(x) for x in items]), F.pmod(key, F.lit(len(items))).cast("int"))


def _cells(spark, sf):
    """part with name, form, day, and the string of the shape that p_partkey chooses; p_size chooses its variant."""
    k, size = F.col("p_partkey"), F.col("p_size")
    name, form = F.initcap("p_name"), _of(_FORMS, F.col("p_partkey") + F.col("p_size"))
    company = F.concat(name, F.lit(" "), form)
    industry = F.initcap(_of(vocab.INDUSTRY_NAMES, k * 7 + size))
    day = F.date_format(F.date_add(F.to_date(F.lit("2019-01-01")), (k * 37 % 2500).cast("int")), "MM/dd/yyyy")
    n = F.concat((k % 9 + 1).cast("string"), F.lit("."), (size % 4 * 25).cast("string"))
    rate = _of(_RATES, k * 3 + size)
    c = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y for y in x])
    odd = size % 2 == 1
    shapes = [
        F.when(odd, c("Debt Investments ", _of(dimensions.SPACED_SECTORS, size), " ", company, " First-lien loan (par, due ", F.substring(day, 4, 7), ") Initial Acquisition Date ", day, " Reference Rate and Spread S + ", n, "% Interest Rate ", n, "%"))
        .otherwise(c("Equity and Other Investments ", company, " Class A Units")),
        F.when(odd, c("Portfolio Company Debt Securities- United States ", _of(dimensions.COUNTRY_SECTORS, size), " ", company, " Type of Investment Secured Loan Investment Date ", day, " Prime + ", n, "% or Floor rate ", n, "%"))
        .otherwise(c("Portfolio Company Equity Investments- United States ", name)),
        c("Investment, Non-Affiliated Issuer, First Lien Debt, ", name, ", ", form, ", ", F.when(odd, industry).otherwise("Delayed Draw")),
        c("Investment | Affiliated Issuer | ", F.when(odd, "Equity").otherwise("First Lien Debt"), " | ", company, " | ", industry, ": Other"),
        F.when(odd, c("Debt Investments ", industry, " and ", company, " and Senior Secured and Maturity Date ", day, " and 1-month ", rate, " - ", n, "%, Floor rate ", n, "%, PIK Interest ", n, "%"))
        .otherwise(c("Equity Investments ", industry, " and Total ", company)),
        F.when(odd, c("Investments-non-controlled/non-affiliated Debt Investments ", industry, " ", company, " Investment First Lien Debt Reference Rate and Spread P + ", n, "% Interest Rate ", n, "% Maturity Date ", day))
        .otherwise(c("Investments - non-controlled/non-affiliated First Lien Debt ", company, " Commitment Type Delayed Draw Term Loan Commitment Expiration Date ", day)),
        F.when(odd, c(company, " | Revolving Loan ", size.cast("string"))).otherwise(c("Senior Secured Loans | Bank Debt | ", company, " | ", industry)),
        F.when(odd, c(name, ", ", form, ", First lien senior secured loan ", size.cast("string")))
        .otherwise(c("DEBT Investment, ", industry, ", ", company, ", Acquisition Date - ", day, ", Investment - Term Loan - ", n, "% (", rate, " + ", n, "%, floor), Net Assets - ", n, "%, Maturity Date - ", day)),
    ]
    cell = F.when(k % 8 == 0, shapes[0])
    for i, s in enumerate(shapes[1:], 1):
        cell = cell.when(k % 8 == i, s)
    return dealt(spark, sf, "part", "p_partkey").select("p_partkey", "p_size", name.alias("name"), form.alias("form"), industry.alias("industry"), cell.alias("cell"))


def _list(items):
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


_INITCAP = "array_to_string(list_transform(string_split({0}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
_AT = "{0}[CAST(({1}) % {2} AS BIGINT) + 1]"
_PARTS = f"""SELECT p_partkey, p_size, {_INITCAP.format("p_name")} AS name, {_AT.format(_list(_FORMS), "p_partkey + p_size", len(_FORMS))} AS form,
  {_INITCAP.format(_AT.format(_list(vocab.INDUSTRY_NAMES), "p_partkey * 7 + p_size", len(vocab.INDUSTRY_NAMES)))} AS industry,
  strftime(DATE '2019-01-01' + CAST(p_partkey * 37 % 2500 AS INTEGER), '%m/%d/%Y') AS day, CAST(p_partkey % 9 + 1 AS VARCHAR) || '.' || CAST(p_size % 4 * 25 AS VARCHAR) AS n,
  {_AT.format(_list(_RATES), "p_partkey * 3 + p_size", len(_RATES))} AS rate, {_AT.format(_list(dimensions.SPACED_SECTORS), "p_size", len(dimensions.SPACED_SECTORS))} AS spaced,
  {_AT.format(_list(dimensions.COUNTRY_SECTORS), "p_size", len(dimensions.COUNTRY_SECTORS))} AS country, p_size % 2 = 1 AS odd FROM part"""
_CELL = """CASE p_partkey % 8
  WHEN 0 THEN CASE WHEN odd THEN 'Debt Investments ' || spaced || ' ' || name || ' ' || form || ' First-lien loan (par, due ' || day[4:] || ') Initial Acquisition Date ' || day || ' Reference Rate and Spread S + ' || n || '% Interest Rate ' || n || '%' ELSE 'Equity and Other Investments ' || name || ' ' || form || ' Class A Units' END
  WHEN 1 THEN CASE WHEN odd THEN 'Portfolio Company Debt Securities- United States ' || country || ' ' || name || ' ' || form || ' Type of Investment Secured Loan Investment Date ' || day || ' Prime + ' || n || '% or Floor rate ' || n || '%' ELSE 'Portfolio Company Equity Investments- United States ' || name END
  WHEN 2 THEN 'Investment, Non-Affiliated Issuer, First Lien Debt, ' || name || ', ' || form || ', ' || CASE WHEN odd THEN industry ELSE 'Delayed Draw' END
  WHEN 3 THEN 'Investment | Affiliated Issuer | ' || CASE WHEN odd THEN 'Equity' ELSE 'First Lien Debt' END || ' | ' || name || ' ' || form || ' | ' || industry || ': Other'
  WHEN 4 THEN CASE WHEN odd THEN 'Debt Investments ' || industry || ' and ' || name || ' ' || form || ' and Senior Secured and Maturity Date ' || day || ' and 1-month ' || rate || ' - ' || n || '%, Floor rate ' || n || '%, PIK Interest ' || n || '%' ELSE 'Equity Investments ' || industry || ' and Total ' || name || ' ' || form END
  WHEN 5 THEN CASE WHEN odd THEN 'Investments-non-controlled/non-affiliated Debt Investments ' || industry || ' ' || name || ' ' || form || ' Investment First Lien Debt Reference Rate and Spread P + ' || n || '% Interest Rate ' || n || '% Maturity Date ' || day ELSE 'Investments - non-controlled/non-affiliated First Lien Debt ' || name || ' ' || form || ' Commitment Type Delayed Draw Term Loan Commitment Expiration Date ' || day END
  WHEN 6 THEN CASE WHEN odd THEN name || ' ' || form || ' | Revolving Loan ' || p_size ELSE 'Senior Secured Loans | Bank Debt | ' || name || ' ' || form || ' | ' || industry END
  ELSE CASE WHEN odd THEN name || ', ' || form || ', First lien senior secured loan ' || p_size ELSE 'DEBT Investment, ' || industry || ', ' || name || ' ' || form || ', Acquisition Date - ' || day || ', Investment - Term Loan - ' || n || '% (' || rate || ' + ' || n || '%, floor), Net Assets - ' || n || '%, Maturity Date - ' || day END END"""


def _x(pattern, group=1, of="cell"):
    p = pattern.replace("'", "''")
    return f"nullif(trim(regexp_extract({of}, '{p}', {group})), '')"


def _iso(x):
    return f"strftime(strptime({x}, '%m/%d/%Y'), '%Y-%m-%d')"


_D = r"(\d{2}/\d{2}/\d{4})"
_N = r"(\d+(?:\.\d+)?)"
_LEGAL = r"(?i)\b(LLC|L\.?L\.?C|LP|L\.?P|LLP|Inc|Corp|Corporation|Company|Co|Ltd|Limited|PLC|GmbH)\.?$"
_WORDS = "|".join(dimensions.INSTRUMENT_WORDS)
_SPACED = "|".join(s.replace("&", "[&]") for s in dimensions.SPACED_SECTORS)
_COUNTRY = "|".join(s.replace("&", "[&]") for s in dimensions.COUNTRY_SECTORS)
_LONGEST = _list(sorted(vocab.INDUSTRY_NAMES, key=lambda x: (-len(x), x)))

# The rules over the cells, in SQL: the shape by how the cell begins, the head by the shape, details by their labels.
_SQL = rf"""
WITH p AS ({_PARTS}), c AS (SELECT p_partkey, {_CELL} AS cell FROM p),
  s AS (SELECT *, CASE
      WHEN regexp_matches(cell, '^(Debt|Equity and Other) Investments .* (First-lien loan|Class A Units)') THEN 'spaced'
      WHEN regexp_matches(cell, '^Portfolio Company .*\sUnited States ') THEN 'country'
      WHEN regexp_matches(cell, '^Investment, ?(Non-)?Affiliated Issuer,') THEN 'issuer'
      WHEN regexp_matches(cell, '^Investment \| (Non-)?Affiliated Issuer \|') THEN 'issuer_piped'
      WHEN regexp_matches(cell, '^(Debt|Equity) Investments? .* and ') THEN 'joined'
      WHEN regexp_matches(cell, '^Investments?[-\s]') THEN 'blob'
      WHEN contains(cell, '|') THEN 'piped' ELSE 'commas' END AS shape,
    list_transform(string_split(cell, ','), lambda x: trim(x)) AS by_comma, list_transform(string_split(cell, '|'), lambda x: trim(x)) AS by_pipe, string_split(cell, ' and ') AS by_and,
    {_x("^(?:Debt|Equity and Other) Investments (.*?) (?:First-lien loan|Class A Units)")} AS spaced_head,
    {_x(r"United States (.*?)(?: Type of Investment .*)?$")} AS country_head,
    trim(regexp_replace(regexp_replace(cell, '^Investments?\s*[-\s]+\s*non-controlled/non-affiliated (?:Debt Investments |First Lien Debt )?', ''), ' (Investment First Lien|Reference Rate|Commitment Type).*$', '')) AS blob_head FROM c),
  t AS (SELECT *, list_max(list_filter(range(4, len(by_comma) + 1), lambda i: regexp_matches(by_comma[i], '{_LEGAL}'))) AS legal,
    list_max(list_filter(range(2, len(by_comma) + 1), lambda i: regexp_matches(lower(regexp_replace(by_comma[i], '\s+\d+$', '')), '{_WORDS}') OR list_contains({_list(vocab.INDUSTRY_NAMES)}, lower(regexp_replace(by_comma[i], '\s+\d+$', ''))))) AS told,
    list_filter({_LONGEST}, lambda x: contains(lower(blob_head), x))[1] AS sector,
    list_filter(by_and[3:], lambda x: regexp_matches(lower(x), 'senior secured|stock|warrant'))[-1] AS by_and_told,
    by_pipe[1] = 'Senior Secured Loans' AS categorized, regexp_matches(cell, '^DEBT Investment\b') AS rich, contains(cell, 'Commitment Type') AS committed,
    array_to_string(by_comma[legal + 1:], ', ') AS tail FROM s)
SELECT p_partkey, shape,
  CASE shape WHEN 'spaced' THEN coalesce({_x(f"^({_SPACED}) (.+)$", 2, "spaced_head")}, spaced_head) WHEN 'country' THEN coalesce({_x(f"^({_COUNTRY}) (.+)$", 2, "country_head")}, country_head)
    WHEN 'issuer' THEN array_to_string(by_comma[4:legal], ', ') WHEN 'issuer_piped' THEN by_pipe[4] WHEN 'joined' THEN CASE WHEN NOT starts_with(lower(by_and[2]), 'total ') AND NOT starts_with(lower(coalesce(by_and[3], '')), 'total ') THEN by_and[2] END
    WHEN 'blob' THEN CASE WHEN NOT committed AND sector IS NOT NULL THEN nullif(trim(blob_head[instr(lower(blob_head), sector) + length(sector):]), '') ELSE blob_head END
    WHEN 'piped' THEN CASE WHEN categorized THEN by_pipe[3] ELSE by_pipe[1] END ELSE CASE WHEN rich THEN by_comma[3] ELSE array_to_string(by_comma[:told - 1], ', ') END END AS company,
  CASE shape WHEN 'spaced' THEN {_x(f"^({_SPACED}) (.+)$", 1, "spaced_head")}
    WHEN 'country' THEN coalesce({_x(f"^({_COUNTRY}) (.+)$", 1, "country_head")}, CASE WHEN NOT regexp_matches(country_head, '(?i)\b(Inc|LLC|Ltd|Corp|LP)\b') THEN country_head END)
    WHEN 'issuer' THEN CASE WHEN lower(tail) <> 'delayed draw' THEN nullif(tail, '') END WHEN 'issuer_piped' THEN trim(string_split(by_pipe[5], ':')[1]) WHEN 'joined' THEN {_x("^(?:Debt|Equity) Investments (.+)$", 1, "by_and[1]")}
    WHEN 'blob' THEN CASE WHEN NOT committed THEN nullif(substr(blob_head, instr(lower(blob_head), sector), length(sector)), '') END
    WHEN 'piped' THEN CASE WHEN categorized THEN by_pipe[4] END ELSE CASE WHEN rich THEN by_comma[2] WHEN NOT regexp_matches(lower(by_comma[told]), '{_WORDS}') THEN regexp_replace(by_comma[told], '\s+\d+$', '') END END AS industry,
  CASE shape WHEN 'spaced' THEN CASE WHEN starts_with(cell, 'Debt') THEN 'DEBT' ELSE 'EQUITY' END WHEN 'country' THEN CASE WHEN contains(cell, 'Equity Investments') THEN 'EQUITY' ELSE 'DEBT' END
    WHEN 'issuer' THEN CASE WHEN regexp_matches(by_comma[3], '(?i)equity|warrant|preferred') THEN 'EQUITY' ELSE 'DEBT' END WHEN 'issuer_piped' THEN CASE WHEN contains(by_pipe[3], 'Equity') THEN 'EQUITY' ELSE 'DEBT' END
    WHEN 'joined' THEN upper({_x("^(Debt|Equity)")}) WHEN 'blob' THEN 'DEBT' WHEN 'piped' THEN CASE WHEN categorized OR regexp_matches(lower(cell[instr(cell, '|'):]), 'revolv|lien') THEN 'DEBT' END ELSE CASE WHEN rich THEN 'DEBT' END END AS kind,
  CASE shape WHEN 'issuer' THEN CASE WHEN lower(tail) = 'delayed draw' THEN tail ELSE by_comma[3] END
    WHEN 'joined' THEN CASE WHEN NOT starts_with(lower(by_and[2]), 'total ') AND NOT starts_with(lower(coalesce(by_and[3], '')), 'total ') THEN by_and_told END
    WHEN 'blob' THEN CASE WHEN committed THEN 'Delayed Draw Term Loan' ELSE {_x("Investment (First Lien Debt)")} END
    WHEN 'piped' THEN CASE WHEN categorized THEN by_pipe[2] ELSE array_to_string(by_pipe[2:], ' | ') END
    WHEN 'commas' THEN CASE WHEN rich THEN {_x(r"Investment - ([^,]+?) - [\d.]+%")} WHEN regexp_matches(lower(by_comma[told]), '{_WORDS}') THEN regexp_replace(by_comma[told], '\s+\d+$', '') END END AS description,
  CASE WHEN shape LIKE 'issuer%' THEN CASE WHEN contains(cell[:60], 'Non-Affiliated') THEN 'non-affiliated' ELSE 'affiliated' END END AS affiliation,
  upper(coalesce(CASE {_x("Spread ([SP]) ")} WHEN 'S' THEN 'SOFR' WHEN 'P' THEN 'PRIME' END, {_x(f"(SOFR|LIBOR|Prime|Euribor|SONIA|Base Rate) [+-] {_N}%")})) AS rate,
  {_x(rf"(?:Spread [SP]|SOFR|LIBOR|Prime|Euribor|SONIA|Base Rate) [+-] {_N}%").join(["CASE WHEN regexp_matches(cell, '(SOFR|LIBOR|Prime|Euribor|SONIA|Base Rate) - [0-9.]+%') THEN '-' ELSE '' END || ", " || '%'"])} AS spread,
  coalesce({_x(rf"Interest Rate {_N}%")}, {_x(rf"Investment - [^,]*?- {_N}%")}) || '%' AS cash_rate, {_x(rf"PIK Interest {_N}%")} || '%' AS pik_rate, {_x(rf"Floor rate {_N}%")} || '%' AS floor, {_x(rf"Net Assets - {_N}%")} || '%' AS net_assets,
  {_iso(_x(rf"(?:Acquisition|Investment) Date (?:- )?{_D}"))} AS acquired, {_iso(_x(rf"(?:Maturity|Commitment Expiration) Date (?:- )?{_D}"))} AS matures
FROM t
"""


@query(_SQL)
def dimension_strings(spark, sf):
    """Eight shapes of dimension strings read into one set of fields."""
    return _cells(spark, sf).select("p_partkey", dimensions.read(F.col("cell")).alias("d")).select("p_partkey", "d.*")


# Names that were cut off, beside strings of segments that hold them whole, twice with details behind.
_RAW = """CASE p_partkey % 3 WHEN 0 THEN 'Investment, Non-Affiliated Issuer, First Lien Debt, ' || name || ', ' || form || ', ' || industry
  WHEN 1 THEN 'DEBT Investment, ' || industry || ', ' || name || ' Holdings, Acquisition Date - ' || day || ', Unsecured Debt, ' || name || ' Group, LLC, Maturity Date - ' || day ELSE name || ', ' || industry || ', Total ' || form END"""
_CUT = "CASE p_size % 4 WHEN 0 THEN 'Group LLC' WHEN 1 THEN lower(name) WHEN 2 THEN 'Warrants - 1.5% ' || name || ' ' || form ELSE name || 'Industry Software' END"


@query(rf"""
WITH p AS ({_PARTS}), c AS (SELECT p_partkey, {_CUT} AS cell, list_transform(string_split({_RAW}, ','), lambda x: trim(x)) AS s FROM p),
  w AS (SELECT p_partkey, e, b, s, list_filter(range(b, e + 1), lambda i: NOT regexp_matches(s[i], '{dimensions.NO_PART}'))[1] AS from_ FROM (SELECT *, unnest(range(greatest(1, e - 4), e + 1)) AS b FROM (SELECT *, unnest(range(1, len(s) + 1)) AS e FROM c))
    WHERE regexp_matches(s[e], '(?i)\b(LLC|L\.?L\.?C|LP|L\.?P|LLP|Inc|Corp|Corporation|Company|Co|Ltd|Limited|PLC|GmbH|Group|Holdings?|Partners?)\b')),
  n AS (SELECT p_partkey, e, b, array_to_string(s[from_:e], ', ') AS n FROM w WHERE from_ IS NOT NULL),
  r AS (SELECT p_partkey, n FROM n WHERE length(n) BETWEEN 4 AND 140 AND NOT regexp_matches(n, '{dimensions.NO_START}') QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY length(n) DESC, e, b) = 1),
  t AS (SELECT p_partkey, regexp_replace(regexp_replace(trim(cell), '([a-z])Industry\b', '\1 Industry'), '(?i)^\s*(?:{dimensions.BEFORE_NAME})\s*-\s*(?:\d+(?:\.\d+)?%?)?\s*', '') AS t FROM c),
  u AS (SELECT p_partkey, nullif(trim(regexp_extract(t, '(?i)\bIndustry\s+([A-Za-z&/\-\s]+)$', 1)), '') AS industry, trim(regexp_replace(t, '(?i)\bIndustry\s+([A-Za-z&/\-\s]+)$', '')) AS t FROM t)
SELECT p_partkey, CASE WHEN t = '' OR regexp_matches(t, '^[a-z]|^(Group|Holdings?|Management)\b') OR (length(t) <= 14 AND regexp_matches(t, '(?i)\b(Group|Holdings?|Development)\b')) THEN coalesce(n, t) ELSE t END AS company, industry
FROM u LEFT JOIN r USING (p_partkey)
""")
def recovered_names(spark, sf):
    """Names that a parser cut off or mixed with a section, made whole from the string they came from."""
    c = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y for y in x])
    d = _cells(spark, sf).withColumn("day", F.date_format(F.date_add(F.to_date(F.lit("2019-01-01")), (F.col("p_partkey") * 37 % 2500).cast("int")), "MM/dd/yyyy"))
    name, form, industry, day = (F.col(x) for x in ("name", "form", "industry", "day"))
    raw = F.when(F.col("p_partkey") % 3 == 0, c("Investment, Non-Affiliated Issuer, First Lien Debt, ", name, ", ", form, ", ", industry))
    raw = raw.when(F.col("p_partkey") % 3 == 1, c("DEBT Investment, ", industry, ", ", name, " Holdings, Acquisition Date - ", day, ", Unsecured Debt, ", name, " Group, LLC, Maturity Date - ", day))
    raw = raw.otherwise(c(name, ", ", industry, ", Total ", form))
    cut = F.when(F.col("p_size") % 4 == 0, "Group LLC").when(F.col("p_size") % 4 == 1, F.lower(name)).when(F.col("p_size") % 4 == 2, c("Warrants - 1.5% ", name, " ", form)).otherwise(c(name, "Industry Software"))
    return d.select("p_partkey", dimensions.sane_company(cut, raw).alias("n")).select("p_partkey", "n.company", "n.industry")
