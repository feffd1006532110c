"""Doubled schedules, quality joins and grades, facts as columns, profiles, reports. Rows of filings are made of the tables' columns."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..operators import aggregate as A
from ..operators import grids, quality, schedules
from .binding import dealt, query, table
from .cleaning import _pick, _sector_sql, _sql_pick
from .facts import SERIES, series

_END = "CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)"
_DOUBLED = """WITH RECURSIVE b AS (SELECT l_suppkey % 5 AS fund, year(l_shipdate) AS period, 'Order ' || l_orderkey AS name, row_number() OVER (PARTITION BY l_suppkey % 5, year(l_shipdate) ORDER BY l_orderkey, l_linenumber, l_quantity) - 1 AS place FROM lineitem),
  n AS (SELECT fund, period, count(*) AS n FROM b GROUP BY 1, 2), r AS (SELECT fund, period, place, name FROM b UNION ALL SELECT fund, period, place + n, name FROM b JOIN n USING (fund, period) WHERE period % 3 = 0) """


def doubled(spark, sf):
    """Lines as positions of five funds a year; every third year's file holds the schedule twice, a little lower the second time."""
    li = table(spark, sf, "lineitem").select((F.col("l_suppkey") % 5).alias("fund"), F.year("l_shipdate").alias("period"), "l_orderkey", "l_linenumber", F.col("l_quantity").alias("value"))
    b = A.ranked_by_spans(li, ["fund", "period"], F.floor(F.col("l_orderkey") / 16384), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("value"), name="place")
    place, twice = F.col("place") - 1, F.col("fund").isNotNull() & F.coalesce(F.col("period") % 3 == 0, F.lit(False))
    again = F.when(twice, F.array(F.struct(place.alias("place"), F.col("value").alias("value")), F.struct((place + F.col("n")).alias("place"), (F.col("value") * 0.97).alias("value"))))
    once = F.array(F.struct(place.alias("place"), F.col("value").alias("value")))
    d = b.select("fund", "period", F.concat(F.lit("Order "), F.col("l_orderkey").cast("string")).alias("name"), F.explode(F.coalesce(again, once)).alias("x"))
    return d.select("fund", "period", "name", "x.value", "x.place")


@query(_DOUBLED + """, m AS (SELECT fund, period, count(*) AS n FROM r GROUP BY 1, 2), e AS (SELECT DISTINCT fund, period, name FROM r JOIN m USING (fund, period) WHERE place < greatest(40, n // 10)),
  f AS (SELECT r.*, m.n, (e.name IS NOT NULL)::INT AS hit FROM r JOIN m USING (fund, period) LEFT JOIN e ON r.fund = e.fund AND r.period = e.period AND r.name = e.name),
  w AS (SELECT *, sum(hit) OVER (PARTITION BY fund, period ORDER BY place ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING) AS h FROM f),
  c AS (SELECT fund, period, place AS cut FROM w WHERE n >= 200 AND hit = 1 AND h >= 4 AND place >= greatest(60, n // 3) AND place < n - 100),
  k AS (SELECT fund, period, min(cut) AS cut FROM c GROUP BY 1, 2 UNION ALL (SELECT c.fund, c.period, min(c.cut) FROM k JOIN c ON c.fund = k.fund AND c.period = k.period AND c.cut > k.cut + 50 GROUP BY 1, 2)) SELECT * FROM k""")
def schedule_restarts(spark, sf):
    return schedules.restarts(doubled(spark, sf), ["fund", "period"], "place", "name")


@query()
def multi_block_repair(spark, sf):
    """The doubled files with the period's own half alone; held against plain loops in the tests."""
    return schedules.repair_blocks(doubled(spark, sf), ["fund"], "period", "place", "name", "value")


@query(SERIES + f""", o AS (SELECT c_mktsegment AS entity, {_END} AS "end", count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS u, min(o_orderkey) AS id FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
  SELECT s.entity, s."end", s.nav, CASE WHEN u % 2 = 1 THEN 'urgent ' || u ELSE '' END AS quality_flags, CASE WHEN id % 4 <> 0 THEN CASE WHEN month(s."end") = 12 THEN '10-K' ELSE '10-Q' END END AS form, CASE WHEN id % 4 <> 0 THEN 'filing/' || id END AS url
  FROM s JOIN o ON s.entity = o.entity AND s."end" = o."end" """)
def quality_periods(spark, sf):
    """Reported values beside the flags and the filing of their period, where it has them."""
    j = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = j.groupBy(F.col("c_mktsegment").alias("entity"), F.date_sub(F.add_months(F.trunc("o_orderdate", "quarter"), 3), 1).alias("end"))
    o = o.agg(F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("u"), F.min("o_orderkey").alias("id"))
    flags = o.filter("u % 2 = 1").select("entity", "end", F.concat(F.lit("urgent "), F.col("u").cast("string")).alias("quality_flags"))
    filings = o.filter("id % 4 <> 0").select("entity", "end", F.when(F.month("end") == 12, "10-K").otherwise("10-Q").alias("form"), F.concat(F.lit("filing/"), F.col("id").cast("string")).alias("url"))
    return quality.quality_periods(series(spark, sf).select("entity", "end", "nav"), flags, filings, ["entity"], "end")


@query(SERIES + f""", p AS (SELECT c_mktsegment AS entity, {_END} AS "end", o_orderkey AS filed, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS fv, o_orderkey % 7 AS flags FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 3 = 0),
  l AS (SELECT entity, "end", max_by(fv, filed) FILTER (WHERE fv IS NOT NULL) AS portfolio, max_by(flags, filed) AS flag_count FROM p GROUP BY 1, 2)
  SELECT s.entity, s."end", s.nii, portfolio, flag_count FROM s LEFT JOIN l ON s.entity = l.entity AND s."end" = l."end" """)
def metric_beside_portfolio(spark, sf):
    j = table(spark, sf, "orders").filter("o_orderkey % 3 = 0").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    p = j.select(F.col("c_mktsegment").alias("entity"), F.date_sub(F.add_months(F.trunc("o_orderdate", "quarter"), 3), 1).alias("end"), F.col("o_orderkey").alias("filed"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("fv"), (F.col("o_orderkey") % 7).alias("flags"))
    return quality.beside_portfolio(series(spark, sf).select("entity", "end", "nii"), p, ["entity"], "end", "filed", "fv", "flags")


@query("""WITH r AS (SELECT l_suppkey, l_partkey, l_linenumber % 4 <> 0 AS v, CASE WHEN l_linenumber % 4 <> 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS fv, l_partkey % 3 <> 0 AS c, l_linenumber = 1 OR l_suppkey % 2 = 0 AS r FROM lineitem),
  g AS (SELECT l_suppkey, count(*) AS "rows", count(DISTINCT l_partkey) AS companies, CAST(sum(fv) AS DOUBLE) / 1000 AS fv_millions, greatest(count(*) FILTER (WHERE v), 1) AS n, count(*) FILTER (WHERE v AND c) AS has_cost, count(*) FILTER (WHERE v AND r) AS has_rate FROM r GROUP BY 1),
  p AS (SELECT * EXCLUDE (n), CAST(round_even(has_cost * 100.0::DOUBLE / n, 0) AS BIGINT) AS cost_pct, CAST(round_even(has_rate * 100.0::DOUBLE / n, 0) AS BIGINT) AS rate_pct FROM g)
  SELECT *, CASE WHEN rate_pct >= 40 AND cost_pct >= 60 THEN 'A' WHEN cost_pct >= 60 THEN 'B' ELSE 'C' END AS grade FROM p""")
def extraction_audit(spark, sf):
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("long").cast("string")
    rows = table(spark, sf, "lineitem").select(
        "l_suppkey", F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("company_name"), F.when(n % 4 != 0, q).otherwise("").alias("fair_value"), F.lit("").alias("amortized_cost"),
        F.when(F.col("l_partkey") % 3 != 0, q).alias("cost"), F.when((n == 1) | (F.col("l_suppkey") % 2 == 0), "5.0%").otherwise(" ").alias("cash_rate"),
    )
    return quality.audit(rows, ["l_suppkey"])


@query("""WITH f AS (SELECT event_id, user_id % 50 AS x, event_id % 4 AS k, event_type = 'purchase' AND event_id % 4 = 0 AND user_id % 3 = 0 AS rich FROM events), d AS (SELECT x, k, bool_or(rich) AS rich FROM f GROUP BY 1, 2)
  SELECT event_id FROM f JOIN d ON f.x = d.x AND f.k = d.k WHERE d.rich OR f.x NOT IN (SELECT x FROM d WHERE rich)""")
def sparse_dimensions(spark, sf):
    """The same company written four ways; those without cost go where another has it."""
    x, k = (F.col("user_id") % 50).cast("string"), F.col("event_id") % 4
    dim = F.when(k == 0, F.concat(F.lit("COMPANY "), x, F.lit(" LLC 1"))).when(k == 1, F.concat(F.lit("Company "), x, F.lit(" LLC, First lien, 5%"))).when(k == 2, F.concat(F.lit("Senior Secured Loans | Tech | Company "), x, F.lit(" LLC")))
    dim = dim.otherwise(F.concat(F.lit("DEBT Investment, Tech, Company "), x, F.lit(" LLC 2")))
    cost = (F.col("event_type") == "purchase") & (k == 0) & (F.col("user_id") % 3 == 0)
    f = table(spark, sf, "events").select("event_id", dim.alias("dim"), F.when(cost, "InvestmentOwnedAtCost").otherwise("InvestmentOwnedAtFairValue").alias("concept"))
    return quality.drop_sparse_dimensions(f, [], "dim", "concept", "atcost$|amortizedcost|interestrate|spread|pikrate").select("event_id")


_CONCEPTS = [
    "InvestmentOwnedAtFairValue", "InvestmentOwnedAtCost", "InvestmentOwnedBalancePrincipalAmount", "InvestmentInterestRatePaidInKind", "InvestmentInterestRate", "InvestmentEstimatedYield",
    "InvestmentBasisSpreadVariableRate", "InvestmentVariableInterestRateType", "InvestmentOwnedBalanceShares", "InvestmentMaturityDate", "Goodwill", "InvestmentVariableInterestRateTypeExtensibleEnumeration",
]
# Addresses of rates: a path, then a name.
_ADDRESSES = ["http://example.org/2024/InvestmentVariableRateType/SOFR", "http://example.org/2024#SoniaMember", "prime", "http://example.org/2024/OneMonthLIBORMember", "http://example.org/Rates/Wibor", "http://example.org/2024#BankBillSwapRateMember"]
_NAMED_RATE = "CASE " + " ".join(f"WHEN contains(a, '{n}') THEN '{n}'" for n in vocab.RATES_IN_URLS) + " ELSE coalesce(MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in vocab.RATE_MEMBERS.items()) + "}[lower(regexp_extract(a, '[^#]*$'))], a) END"


@query(f"""WITH e AS (SELECT user_id, event_id, event_id % 12 AS k, CAST(CAST(floor(abs(value)) AS BIGINT) % 90 + 1 AS VARCHAR) AS x, upper(regexp_extract({_sql_pick("user_id", _ADDRESSES)}, '[^/]*$')) AS a FROM events WHERE event_id % 12 <> 10),
  f AS (SELECT user_id, event_id, k, CASE WHEN k = 11 THEN {_NAMED_RATE} ELSE x END AS v FROM e),
  g AS (SELECT user_id, """ + ", ".join(f"max_by(v, event_id) FILTER (WHERE k = {k}) AS c{k}" for k in range(12)) + """, min_by(v, event_id) FILTER (WHERE k = 5) AS yield, min_by(v, event_id) FILTER (WHERE k = 7) AS rate FROM f GROUP BY 1)
  SELECT user_id, c0 AS fair_value, c1 AS amortized_cost, c1 AS cost, c2 AS principal_amount, c3 AS pik_rate, coalesce(c4, yield) AS cash_rate, CAST(NULL AS VARCHAR) AS floor_rate, c6 AS spread, coalesce(c11, rate, CASE WHEN c6 IS NOT NULL THEN 'SOFR' END) AS reference_rate,
    CAST(NULL AS VARCHAR) AS rate_cap, c8 AS shares, CAST(NULL AS VARCHAR) AS percent_of_net_assets, CAST(NULL AS VARCHAR) AS acquisition_date, c9 AS maturity_date, CAST(NULL AS VARCHAR) AS undrawn_commitment, CAST(NULL AS VARCHAR) AS commitment_limit,
    CASE WHEN c2 IS NOT NULL OR c6 IS NOT NULL THEN 'First Lien' WHEN c8 IS NOT NULL THEN 'Other Equity' ELSE 'Other' END AS investment_type FROM g""")
def fact_columns(spark, sf):
    """An event is a fact of its user's position: the concept by its number, the value in whole figures or as a rate's address."""
    v = (F.floor(F.abs("value")) % 90 + 1).cast("string")
    v = F.when(F.col("event_id") % 12 == 11, _pick(F.col("user_id"), _ADDRESSES)).otherwise(v)
    f = table(spark, sf, "events").select("user_id", "event_id", _pick(F.col("event_id"), _CONCEPTS).alias("concept"), v.alias("v"))
    return quality.fact_columns(f, ["user_id"], "concept", "v", "event_id")


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS q, l_linenumber % 2 = 1 AS u, count(*) OVER (PARTITION BY l_orderkey) AS n, count(*) FILTER (WHERE l_linenumber % 2 = 1) OVER (PARTITION BY l_orderkey) AS m FROM lineitem)
  SELECT l_orderkey, string_agg('part ' || l_partkey || '|' || CASE WHEN l_linenumber = 1 THEN '5' ELSE '' END || '|' || q || CASE WHEN u AND (n - m) * 10 <= n * 8 THEN '%' ELSE '' END, ';' ORDER BY l_linenumber, l_partkey, q) AS data, 'Company|Rate|Amount' AS head FROM r GROUP BY 1""")
def spacer_columns(spark, sf):
    """An order is a table with two empty columns, one of rates that is mostly empty and one of signs."""
    # Lines go to one place once, where a table is put together as a grid; all that follows is within its row.
    line = F.struct("l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("q"))
    li = dealt(spark, sf, "lineitem", "l_orderkey").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("x"))
    blank = F.lit("")

    def row(x):
        rate, sign = F.when(x["l_linenumber"] == 1, "5").otherwise(blank), F.when(x["l_linenumber"] % 2 == 1, "%").otherwise(blank)
        return F.array(F.concat(F.lit("part "), x["l_partkey"].cast("string")), blank, rate, blank, x["q"].cast("string"), sign)

    heads = F.array(*[F.lit(x) for x in ("Company", "", "Rate", "", "Amount", "")])
    kept = li.select("l_orderkey", grids.without_spacers(F.concat(F.array(heads), F.transform("x", row))).alias("grid"))
    lines = kept.select("l_orderkey", F.transform("grid", lambda r: F.array_join(r, "|")).alias("t"))
    return lines.select("l_orderkey", F.get("t", 0).alias("head"), F.array_join(F.slice("t", 2, F.size("t")), ";").alias("data"))


@query("""WITH e AS (SELECT o_custkey, count(DISTINCT o_orderpriority) AS funds, CAST(sum(CAST(round(o_totalprice, 4) AS DECIMAL(18,4))) AS DOUBLE) AS x FROM orders GROUP BY 1)
  SELECT 'co_' || o_custkey AS company_id, c_name AS canonical_name FROM e JOIN customer ON o_custkey = c_custkey WHERE funds >= 2 AND c_custkey % 7 <> 0 ORDER BY x DESC, company_id LIMIT 10""")
def leading_companies(spark, sf):
    """The ten largest borrowers of two or more priorities; every seventh name is a subtotal's."""
    e = table(spark, sf, "orders").groupBy("o_custkey").agg(F.countDistinct("o_orderpriority").alias("funds"), F.sum(F.round("o_totalprice", 4).cast("decimal(18,4)")).cast("double").alias("exposure_m"))
    e = e.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    name = F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("Sub Total "), "c_name")).otherwise(F.col("c_name"))
    return quality.leading_companies(e.select(F.concat(F.lit("co_"), F.col("o_custkey").cast("string")).alias("company_id"), name.alias("company_name"), "funds", "exposure_m"))


@query("""WITH p AS (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS told FROM orders WHERE o_custkey % 4 <> 0 GROUP BY 1), t AS (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN told END AS day, o_custkey IS NOT NULL AS has FROM customer LEFT JOIN p ON c_custkey = o_custkey),
  w AS (SELECT c_custkey, 'stale' AS why FROM t WHERE NOT has OR day IS NULL OR DATE '1998-08-01' - day >= 30 UNION ALL SELECT c_custkey, 'empty' FROM t WHERE NOT has OR c_custkey % 2 = 0)
  SELECT 'co_' || c_custkey AS company_id, why FROM w""")
def profile_worklist(spark, sf):
    """Customers whose profile (the date of their last order) is missing or old, and those whose profile says nothing."""
    c = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("co_"), F.col("c_custkey").cast("string")).alias("company_id"))
    p = table(spark, sf, "orders").filter("o_custkey % 4 <> 0").groupBy("o_custkey").agg(F.max("o_orderdate").cast("date").alias("at"))
    p = p.select(F.concat(F.lit("co_"), F.col("o_custkey").cast("string")).alias("company_id"), F.when(F.col("o_custkey") % 5 != 0, F.col("at")).alias("updated_at"), F.when(F.col("o_custkey") % 2 == 0, " ").otherwise("text").alias("description"))
    now = F.lit("1998-08-01").cast("date")
    due = lambda why, empty: quality.profiles_due(c, p, now, empty).select("company_id", F.lit(why).alias("why"))
    return due("stale", False).unionByName(due("empty", True))


_ALLOWED = [x for k, x in enumerate(vocab.SECTOR_WORDS) if k % 2 == 0]
_IN = ", ".join("'" + x.replace("'", "''") + "'" for x in _ALLOWED)


@query(f"""WITH s AS (SELECT c_custkey, coalesce(trim(c_mktsegment), '') AS own, {_sector_sql("coalesce(c_mktsegment, '')")} AS sector FROM customer)
  SELECT 'co_' || c_custkey AS company_id, own AS industry_initial, CASE WHEN own = '' THEN '' WHEN sector = '' OR sector IN ({_IN}) THEN sector ELSE 'Other' END AS skeleton, CASE WHEN c_custkey % 2 = 0 AND told <> '' THEN told ELSE own END AS industry
  FROM s JOIN (SELECT c_custkey, {_sector_sql(_sql_pick('c_custkey', ['software', 'Cash', 'legal', 'Oil & Gas']))} AS told FROM customer) USING (c_custkey)""")
def profile_industries(spark, sf):
    """Skeleton profiles with an allowed sector, and exposures whose industry a profile overrides (every second customer has one)."""
    c = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("co_"), F.col("c_custkey").cast("string")).alias("company_id"), F.col("c_name").alias("canonical_name"), F.col("c_mktsegment"))
    bare = quality.skeletons(c, "c_mktsegment", _ALLOWED).select("company_id", "industry_initial", F.col("industry").alias("skeleton"))
    told = c.filter("c_custkey % 2 = 0").select("company_id", _pick(F.col("c_custkey"), ["software", "Cash", "legal", "Oil & Gas"]).alias("industry"))
    return quality.profile_industry(bare.withColumn("industry", F.col("industry_initial")), told, "industry")


@query("""SELECT o_orderkey, o_orderpriority, y, pct, CAST(rank AS INTEGER) AS rank, pct > 15 AS is_large FROM (SELECT o_orderkey, o_orderpriority, year(o_orderdate) AS y, o_totalprice / 30000 AS pct, row_number() OVER (PARTITION BY o_orderpriority, year(o_orderdate) ORDER BY o_totalprice / 30000 DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 10 OR pct > 15""")
def holding_report(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("y"), (F.col("o_totalprice") / 30000).alias("pct"))
    return quality.holding_report(o, ["o_orderpriority", "y"], "pct", "o_orderkey")


@query("""WITH n AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2), k AS (SELECT c_nationkey FROM n GROUP BY 1 HAVING CAST(max(n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) > 0.3) SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT c_nationkey FROM k)""")
def dominated_labels(spark, sf):
    """Customers of nations where no segment has more than 30 per cent."""
    return quality.drop_dominated(table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), ["c_nationkey"], "c_mktsegment", 0.3).select("c_custkey")


@query("""SELECT o_orderkey, CASE WHEN k < 2 THEN 'T' || o_custkey END AS ticker, CASE WHEN k < 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date, CASE k WHEN 0 THEN 'balance_sheet' WHEN 1 THEN 'income_statement' END AS type FROM (SELECT *, o_orderkey % 4 AS k FROM orders)""")
def statement_files(spark, sf):
    """Paths of statements, of other files and of names that look alike."""
    k, t, d = F.col("o_orderkey") % 4, F.concat(F.lit("data/T"), F.col("o_custkey").cast("string")), F.date_format("o_orderdate", "_yyyy-MM-dd")
    path = F.when(k == 0, F.concat(t, d, F.lit("_balance_sheet.csv"))).when(k == 1, F.concat(t, d, F.lit("_10-K_income_statement.csv"))).when(k == 2, F.concat(t, d, F.lit("_cash_flow.csv"))).otherwise(F.concat(t, F.lit("_balance_sheet.csv")))
    return table(spark, sf, "orders").select("o_orderkey", quality.statement_file(path).alias("f")).select("o_orderkey", "f.*")


# Names of files: the customer, a word and an ending by the order's key and customer.
_WORDS_OF_FILES = ["-2024", "_htm", "_cal", "-schema", "_lab", "_def", "_pre", "presentation", "xbrl", "R1"]
_ENDINGS = [".xml", ".htm", ".html", ".XML", ".xsd", "_xbrl.htm", "Xbrl.html", ".jpg"]


@query(f"""WITH f AS (SELECT o_custkey, o_orderkey, lower('c' || o_custkey || {_sql_pick("o_orderkey", _WORDS_OF_FILES)} || {_sql_pick("o_orderkey * 3 + o_custkey", _ENDINGS)}) AS f FROM orders)
  SELECT o_custkey, min(o_orderkey) AS seq FROM f WHERE (contains(f, '.xml') OR contains(f, 'xbrl.htm')) AND NOT contains(f, 'schema') AND NOT contains(f, 'calculation') AND NOT contains(f, 'definition') AND NOT contains(f, 'label') AND NOT contains(f, 'presentation')
    AND NOT contains(f, 'cal.xml') AND NOT contains(f, 'def.xml') AND NOT contains(f, 'lab.xml') AND NOT contains(f, 'pre.xml') GROUP BY 1""")
def instance_documents(spark, sf):
    """A customer's orders are the files of a filing."""
    name = F.concat(F.lit("c"), F.col("o_custkey").cast("string"), _pick(F.col("o_orderkey"), _WORDS_OF_FILES), _pick(F.col("o_orderkey") * 3 + F.col("o_custkey"), _ENDINGS))
    d = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("seq"), name.alias("file"))
    return quality.instance_documents(d, ["o_custkey"], "file", "seq").select("o_custkey", "seq")


@query(r"""SELECT page_id, right(trim(regexp_replace(regexp_replace(substr(html, 1, CAST(length(html) // 2 AS BIGINT)), '<[^>]+>', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g')), 500) AS before FROM pages""")
def text_before(spark, sf):
    """The last 500 letters of text before the middle of each page."""
    return table(spark, sf, "pages").select("page_id", quality.text_before(F.col("html"), F.floor(F.length("html") / 2)).alias("before"))
