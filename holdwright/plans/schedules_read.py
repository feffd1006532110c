"""Pages of schedules, written from orders and their lines, read back as records."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import grids
from ..sources import documents
from .binding import dealt, query
from .cleaning import _pick, _sql_pick

# First cells of rows: sections, industries, sums, pieces of names, blanks and companies, by the part's key.
_FIRST = [
    "Senior Secured First Lien Debt - 12.5%", "Subordinated Debt - 3.1%", "Aerospace & Defense", "Energy: Oil & Gas - 7%", "Total Investments", "", "abc Inc.", "Joint Ventures-2.2%",
    "Part {0} LLC (Revolver)", "Part {0}, Inc. (2)", "Part {0} Holdings",
]
_KINDS = ["", "Common Stock", "First Lien Senior Secured Loan - Delayed Draw", "Warrants", "Secured Debt, junior"]
_HEADS = ["Portfolio Company", "Investment Type", "Maturity Date", "Principal Amount", "Amortized Cost", "Fair Value"]
# The two rows that the second table's heads are dealt to.
_UPPER, _LOWER = ["", "", "", "", "Amortized Cost", "Fair Value"], ["Portfolio Company", "Investment Type", "Maturity Date", "Principal Amount", "", ""]
_FORMS = "(" + "|".join(f.replace(".", r"\.") for f in grids.FORMS) + ")"
_NAMES = ", ".join("'" + x + "'" for x in [*grids.CATEGORIES, *grids.INDUSTRIES])
_LABELS = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in grids.INDUSTRIES.items()) + "}"


def _html(rows, heads):
    """An HTML table of rows (an array of them, written out) below rows of heads."""
    return F.concat(F.lit("<table>"), F.lit(heads), F.array_join(rows, "\n"), F.lit("</table>"))


@query(rf"""
WITH l AS (SELECT l_orderkey, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber > 3) - 1 AS idx, 1 + row_number() OVER (PARTITION BY l_orderkey, l_linenumber > 3 ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity) AS r,
    replace({_sql_pick("l_partkey", _FIRST)}, '{{0}}', CAST(l_partkey AS VARCHAR)) AS first, {_sql_pick("l_suppkey", _KINDS)} AS told, l_shipdate, l_quantity FROM lineitem),
  c AS (SELECT *, first = '' OR regexp_matches(lower(first), '{_FORMS}') AS filled, trim(regexp_replace(regexp_replace(first, '(\s*\(\d{{1,2}}\))+$', ''), '\s*\(Revolver\)$', '')) AS bare,
    CASE WHEN contains(first, '(Revolver)') THEN 'Revolver' END AS inferred, trim(regexp_replace(lower(first), '-\s*\d+\.?\d*\s*%?\s*$', '')) AS section FROM l),
  k AS (SELECT *, CASE WHEN length(first) >= 5 AND regexp_matches(first, '-\s*\d+\.?\d*\s*%') AND NOT regexp_matches(lower(first), '{_FORMS}') AND regexp_matches(lower(first), 'first lien|second lien|subordinated debt|unsecured debt') THEN 'section'
      WHEN regexp_matches(lower(first), '-\s*\d+\.?\d*\s*%?\s*$') AND regexp_matches(lower(first), '^(first lien|second lien|senior secured|subordinated|unsecured|joint ventures|derivatives)') THEN 'summary'
      WHEN length(bare) >= 3 AND section IN ({_NAMES}) THEN 'category' WHEN length(bare) <= 15 AND regexp_matches(bare, '^[A-Za-z]{{1,4}}\s+(Inc\.?|LLC\.?)$') THEN 'fragment'
      WHEN first = '' THEN 'continued' WHEN starts_with(lower(first), 'total ') THEN 'other' WHEN filled OR regexp_matches(first, '^[A-Z]') THEN 'data' ELSE 'other' END AS kind FROM c),
  w AS (SELECT *, last_value(CASE WHEN kind = 'section' THEN CASE WHEN contains(lower(first), 'first lien') THEN 'First Lien' ELSE 'Subordinated Debt' END END IGNORE NULLS) OVER t AS section_kind,
    last_value(CASE WHEN kind = 'data' THEN bare END IGNORE NULLS) OVER t AS company, last_value(CASE WHEN kind = 'category' THEN {_LABELS}[section] END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY idx, r) AS industry FROM k
    WINDOW t AS (PARTITION BY l_orderkey, idx ORDER BY r)),
  x AS (SELECT *, coalesce(CASE WHEN kind = 'data' THEN inferred END, nullif(CASE WHEN filled THEN trim(replace(told, ',', ' ')) ELSE '' END, ''), section_kind, 'First Lien') AS said FROM w WHERE kind = 'data' OR (kind = 'continued' AND company IS NOT NULL))
SELECT l_orderkey, idx, CAST(r AS INTEGER) AS r, company AS company_name,
  CASE WHEN contains(lower(said), 'secured debt') AND NOT contains(lower(said), 'second') THEN 'First Lien' WHEN contains(lower(said), 'common stock') THEN 'Common Equity' WHEN contains(lower(said), ' - delayed draw') THEN 'Delayed Draw'
    WHEN contains(lower(said), 'first lien senior secured loan') THEN 'First Lien' WHEN contains(lower(said), 'subordinated debt') THEN 'Subordinated Debt' ELSE said END AS investment_type, industry,
  CASE WHEN filled THEN strftime(l_shipdate, '%Y-%m-%d') END AS maturity_date, CASE WHEN filled THEN l_quantity * 1000 END AS principal_amount, CASE WHEN filled THEN l_quantity END AS amortized_cost, CASE WHEN filled THEN l_quantity END AS cost, CASE WHEN filled THEN -l_quantity END AS fair_value
FROM x
""")
def schedule_records(spark, sf):
    """An order is a page with up to two tables: the first under a title, the second with its heads in two rows."""
    n = F.col("l_linenumber")
    first = F.replace(_pick(F.col("l_partkey"), _FIRST), F.lit("{0}"), F.col("l_partkey").cast("string"))
    filled = (first == "") | F.lower(first).rlike(_FORMS)
    cell = lambda c: F.when(filled, c).otherwise("")
    q = F.format_number("l_quantity", 2)
    row = (first, cell(_pick(F.col("l_suppkey"), _KINDS)), cell(F.date_format("l_shipdate", "MM/dd/yyyy")), cell(F.concat(F.lit("$ "), F.format_number(F.col("l_quantity") * 1000, 2))), cell(q), cell(F.concat(F.lit("("), q, F.lit(")"))))
    # Rows are written before they are put together, where no lambda runs over their cells.
    written = F.concat(F.lit("<tr>"), *[x for c in row for x in (F.lit("<td>"), F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("</td>"))], F.lit("</tr>"))
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"))
    # Pages are parsed in Python, so small tables too are dealt to all cores; lines go there once, before their cells are written.
    lines = dealt(spark, sf, "lineitem", "l_orderkey").select("l_orderkey", F.struct(place.alias("place"), (n > 3).alias("second"), written.alias("row")).alias("x"))
    pages = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("x")).alias("x"))
    rows = lambda second: F.transform(F.filter("x", lambda x: x["second"] == second), lambda x: x["row"])
    tr = lambda cells: "<tr>" + "".join(f"<th>{c}</th>" for c in cells) + "</tr>"
    title = "<tr><th colspan='6'>Consolidated schedule, in thousands</th></tr>"
    both = F.when(F.size(rows(True)) > 0, _html(rows(True), tr(_UPPER) + tr(_LOWER))).otherwise("")
    html = F.concat(F.lit("<html><body>"), F.when(F.size(rows(False)) > 0, _html(rows(False), title + tr(_HEADS))).otherwise(""), both, F.lit("</body></html>"))
    found = documents.html_tables(pages.select("l_orderkey", html.alias("html")), "l_orderkey", "html", repeat=False, least=0)
    out = grids.records(found).select(F.col("doc").cast("long").alias("l_orderkey"), "idx", "r", *[f for f in ("company_name", "investment_type", "industry", "maturity_date", "principal_amount", "amortized_cost", "cost", "fair_value")])
    return out.select("l_orderkey", "idx", F.col("r").cast("int").alias("r"), *out.columns[3:])
