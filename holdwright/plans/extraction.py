"""Filing rows out of tables and text: names, rates, heads, money cells, schedules. Cells are written from the tables' columns and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import credit, names, rates, vocab
from ..operators import aggregate as A
from ..operators import filings, grids, reconcile
from ..sources import documents
from ..sources import facts as sources_facts
from .binding import dealt, query, table
from .cleaning import _pick, _sql_pick

_FORMS = ["L.L.C.", "Incorporated", "Inc", "Corporation", "Corp.", "L.P.", "Ltd", "llc"]
_FORMS_WANT = ["LLC", "Inc.", "Inc.", "Corp.", "Corp.", "LP", "Ltd.", "LLC"]
_TAILS = [" - Delayed Draw", " (2)(12)", " (formerly Old Name)", " Class A-1 Units", " - Common Equity", " SOFR+5.75% 1.00% LIBOR Floor 4/7/2022", " -", ", First Lien Term Loan", ""]
_LEADS = ["", "First Lien - ", "Second Lien - ", "", "Warrant Investments and Machines and "]
_BASE = "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def company_cells(spark, sf):
    base = F.concat(F.initcap("p_name"), F.lit(" "), _pick(F.col("p_partkey"), _FORMS))
    return dealt(spark, sf, "part", "p_partkey").select("p_partkey", F.concat(_pick(F.col("p_partkey") + F.col("p_size"), _LEADS), base, _pick(F.col("p_size"), _TAILS)).alias("cell"))


@query(f"SELECT p_partkey, {_BASE} || ' ' || {_sql_pick('p_partkey', _FORMS_WANT)} AS name, sha256(lower({_BASE} || ' ' || {_sql_pick('p_partkey', _FORMS_WANT)})) AS id FROM part")
def clean_companies(spark, sf):
    """Names with section words before and figures, instruments, notes and classes behind, brought back to name and legal form."""
    c = company_cells(spark, sf).select("p_partkey", names.clean_company(F.col("cell"))["name"].alias("name"))
    return c.withColumn("id", F.sha2(F.lower("name").cast("binary"), 256))


@query(f"""WITH n AS (SELECT p_partkey, {_BASE} || ' ' || {_sql_pick('p_partkey', _FORMS_WANT)} AS name FROM part), x AS (SELECT DISTINCT name FROM n WHERE p_partkey % 3 <> 0)
  SELECT n.p_partkey, CASE WHEN x.name IS NOT NULL THEN 'known ' || x.name ELSE 'co_' || substr(sha256(lower(n.name)), 1, 12) END AS company_id FROM n LEFT JOIN x ON n.name = x.name""")
def holdings_company_ids(spark, sf):
    """Rows meet the company index by their cleaned name; unknown names get a hash."""
    cells = company_cells(spark, sf)
    known = cells.filter("p_partkey % 3 <> 0").select(names.clean_company(F.col("cell"))["name"].alias("name")).distinct()
    index = known.withColumn("company_id", F.concat(F.lit("known "), "name"))
    return filings.with_company_id(cells.withColumnRenamed("cell", "company_name"), "company_name", index).select("p_partkey", "company_id")


_SUFFIXES = [" - First Lien Term Loan", ", Preferred Stock", " - Warrants", " - Revolving Credit Facility", " - Membership Interests", " - Mezzanine Debt", ""]
_SUFFIX_TYPES = ["First Lien", "Preferred Equity", "Warrants", "Revolver", "Partnership Interest", "Subordinated Debt", ""]


@query(f"SELECT p_partkey, p_name AS name, nullif({_sql_pick('p_size', _SUFFIX_TYPES)}, '') AS type FROM part")
def instrument_suffixes(spark, sf):
    p = table(spark, sf, "part")
    s = names.instrument_suffix(F.concat("p_name", _pick(F.col("p_size"), _SUFFIXES)))
    return p.select("p_partkey", s.alias("s")).select("p_partkey", "s.name", "s.type")


# A rate told in words: what is said before and behind a figure of the order's customer and clerk.
_SAID = ["a fixed rate of about ", "fixed rate ", "pays ", "SOFR plus a margin, now ", "coupon ", "LIBOR + ", "fixed interest rate: ", "in all "]
_BEHIND = ["%", "% cash", "", "% PIK and 1.5% cash", "% a year"]
_TERMS_CELL = f"{_sql_pick('o_orderkey', _SAID)} || printf('%.2f', (o_custkey % 600) / 4.0) || {_sql_pick('o_custkey', _BEHIND)}"


@query(rf"""WITH c AS (SELECT o_orderkey, lower({_TERMS_CELL}) AS cell FROM orders),
  r AS (SELECT o_orderkey, cell, coalesce(nullif(regexp_extract(cell, 'fixed (?:interest )?rate:? ([0-9.]+)', 1), ''), nullif(regexp_extract(cell, '([0-9.]+)%? cash', 1), '')) AS told,
    CASE WHEN NOT regexp_matches(cell, 'sofr|libor|[+]') THEN regexp_extract(cell, '([0-9.]+)%', 1) END AS alone FROM c),
  x AS (SELECT o_orderkey, coalesce(CAST(told AS DOUBLE), CASE WHEN TRY_CAST(alone AS DOUBLE) > 0 AND TRY_CAST(alone AS DOUBLE) < 50 THEN CAST(alone AS DOUBLE) END) AS x FROM r)
  SELECT o_orderkey, CASE WHEN x IS NULL THEN '' ELSE regexp_replace(printf('%.2f', x), '\.?0+$', '') || '%' END AS rate FROM x""")
def rates_of_terms(spark, sf):
    """Rates told in words: fixed, cash, a margin over a benchmark (which is no rate), a lone percentage."""
    o = table(spark, sf, "orders")
    cell = F.concat(_pick(F.col("o_orderkey"), _SAID), F.format_string("%.2f", (F.col("o_custkey") % 600) / 4.0), _pick(F.col("o_custkey"), _BEHIND))
    return o.select("o_orderkey", rates.of_terms(cell).alias("rate"))


# A rate's cell: a tenor and a unit by the order's customer, a name by its key, a word behind by its status.
_UNITS = ["", "{0}-month ", "{0} month ", "{0}M ", "{0}m"]
_NAMED = [*vocab.RATE_TOKENS, "gilt", "treasury", "Wibor", "swap"]
_AFTER = ["", " rate", " index", " floor", " note"]
_TENOR = "CAST(o_custkey % 12 + 1 AS VARCHAR)"
_TOKEN_CELL = f"replace({_sql_pick('o_custkey', _UNITS)}, '{{0}}', {_TENOR}) || {_sql_pick('o_orderkey', _NAMED)} || {_sql_pick('o_orderkey + o_custkey', _AFTER)}"


@query(rf"""WITH c AS (SELECT o_orderkey, {_TOKEN_CELL} AS cell FROM orders),
  t AS (SELECT *, trim(regexp_replace(regexp_replace(lower(trim(cell)), '(\d+)[\s-]month\s+', '\1m '), '\s+(rate|index|benchmark|floor)$', '')) AS token FROM c)
  SELECT o_orderkey, cell, token, list_contains([{", ".join(f"'{x}'" for x in vocab.RATE_TOKENS)}], lower(trim(cell))) OR list_contains([{", ".join(f"'{x}'" for x in vocab.RATE_TOKENS)}], token)
    OR regexp_matches(lower(trim(cell)), '^\d+m?\s*(sofr|libor|l)$') OR regexp_matches(token, '^\d+m?\s*(sofr|libor|l)$') AS known FROM t""")
def rate_tokens(spark, sf):
    """Tenors, names and words of rates joined: their form for comparison, and whether they are known."""
    unit = F.replace(_pick(F.col("o_custkey"), _UNITS), F.lit("{0}"), (F.col("o_custkey") % 12 + 1).cast("string"))
    cell = F.concat(unit, _pick(F.col("o_orderkey"), _NAMED), _pick(F.col("o_orderkey") + F.col("o_custkey"), _AFTER))
    return table(spark, sf, "orders").select("o_orderkey", cell.alias("cell")).select("o_orderkey", "cell", names.rate_token(F.col("cell")).alias("token"), names.is_rate_token(F.col("cell")).alias("known"))


_NOTES = ["", "Level 1 and Level 2 and Level 3", "Purchases, sales or payoffs, end of period", "cash flows from operating activities: net cash provided by", "Net change in unrealized appreciation ($ in millions)", "Level 2 alone"]


@query(f"""SELECT page_id, (contains(t, 'level 1') AND contains(t, 'level 2') AND contains(t, 'level 3')) OR (contains(t, 'purchases') AND (contains(t, 'sales or payoffs') OR contains(t, 'pay-offs')) AND (contains(t, 'beginning of period') OR contains(t, 'end of period')))
  OR (contains(t, 'cash flows from operating activities') AND contains(t, 'net cash provided by')) AS other FROM (SELECT page_id, lower(coalesce(html, '') || {_sql_pick('page_id', _NOTES)}) AS t FROM pages)""")
def other_tables(spark, sf):
    """Pages with a note behind: which are tables that only mention investments."""
    t = F.concat(F.coalesce("html", F.lit("")), _pick(F.col("page_id"), _NOTES))
    return table(spark, sf, "pages").select("page_id", filings.is_other_table(t).alias("other"))


# Heads of tables: a date in one of several spellings, of the period or of a year's end before or behind it, with words before it.
_BEFORE = ["Schedule as of ", "", "Balances at ", "for the year ended "]
_SPELLED = ["%B %d, %Y", "%b. %d, %Y", "%m/%d/%Y", "%Y-%m-%d"]
_SPELLED_SPARK = ["MMMM dd, yyyy", "MMM. dd, yyyy", "MM/dd/yyyy", "yyyy-MM-dd"]
_SHOWN = lambda d: "CASE CAST(o_custkey % 4 AS INT) " + " ".join(f"WHEN {k} THEN strftime({d}, '{f}')" for k, f in enumerate(_SPELLED)) + " END"
_PERIOD = "CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)"
_YEAR_END = f"make_date(CAST(year({_PERIOD}) - o_orderkey % 3 AS INT), 12, 31)"
_DATED = f"CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN {_SHOWN(_PERIOD)} || ' and ' || {_SHOWN(_YEAR_END)} WHEN 1 THEN {_SHOWN(_PERIOD)} WHEN 4 THEN 'no date' ELSE {_SHOWN(_YEAR_END)} END"


@query(rf"""WITH c AS (SELECT o_orderkey, {_PERIOD} AS p, lower({_sql_pick("o_orderkey", _BEFORE)} || {_DATED}) AS t FROM orders),
  x AS (SELECT *, regexp_matches(t, '(as\s+of|at)\s+' || lower(monthname(p)) || '\s+0?' || day(p) || '[,\s]+' || year(p)) AS as_of,
    regexp_matches(t, lower(monthname(p)) || '\s+0?' || day(p) || '[,\s]+' || year(p) || '|' || lower(left(monthname(p), 3)) || '\.?\s+0?' || day(p) || '[,\s]+' || year(p) || '|\b0?' || month(p) || '/0?' || day(p) || '/' || year(p) || '\b|\b' || strftime(p, '%Y-%m-%d') || '\b') AS bare,
    coalesce(TRY_CAST(nullif(regexp_extract(t, '(?:december|dec\.?)\s+31[,\s]+(\d{{4}})', 1), '') AS INT) < year(p), false) OR coalesce(TRY_CAST(nullif(regexp_extract(t, '\b12[/-]31[/-](\d{{4}})\b', 1), '') AS INT) < year(p), false) AS earlier FROM c)
  SELECT o_orderkey, NOT (as_of OR (bare AND NOT (month(p) = 12 AND day(p) = 31))) AND earlier AS prior FROM x""")
def prior_year_tables(spark, sf):
    """Heads of tables: the period's end, year's ends, both, or none, as words, abbreviated, as numbers and as ISO text."""
    o = table(spark, sf, "orders").withColumn("end", F.date_sub(F.add_months(F.trunc("o_orderdate", "quarter"), 3), 1))
    year_end = F.make_date((F.year("end") - F.col("o_orderkey") % 3).cast("int"), F.lit(12), F.lit(31))

    def shown(d):
        out = None
        for k, f in enumerate(_SPELLED_SPARK):
            c = (F.col("o_custkey") % 4) == k
            out = F.when(c, F.date_format(d, f)) if out is None else out.when(c, F.date_format(d, f))
        return out

    k = F.col("o_orderkey") % 5
    dated = F.when(k == 0, F.concat(shown(F.col("end")), F.lit(" and "), shown(year_end))).when(k == 1, shown(F.col("end"))).when(k == 4, "no date").otherwise(shown(year_end))
    return o.select("o_orderkey", filings.is_prior_year_table(F.concat(_pick(F.col("o_orderkey"), _BEFORE), dated), F.col("end")).alias("prior"))


# Heads by the part's key and size: eleven columns, each with a phrase of its own place; the second row fills the blanks of the first.
_HEADS = ["Portfolio Company (1)", "", "Issuer", "Type of Investment", "Business Description", "Total Rate", "Interest", "PIK", "Spread Above Index", "Acquisition", "Due Date", "Par", "Cost", "Fair Value", "% of Net Assets",
          "Notes", "Unfunded", "Principal", "Amortized Cost", "Sector", "Name", "Footnotes", "A title of the schedule that is much longer than fifty characters"]
_WIDE = 11
_HEAD_AT = lambda i, shift: f"{_sql_pick(f'p_partkey * {i + 3} + p_size * {i * i + 1 + shift}', _HEADS)}"


def _able(h):
    """SQL: the fields that a head may have, in order."""
    cases = []
    for f, words in grids.HEAD_PHRASES.items():
        some = " OR ".join(f"contains({h}, '{w}') OR contains('{w}', {h})" for w in words)
        cases.append(f"CASE WHEN {some} THEN '{f}' END")
    return f"CASE WHEN {h} = '' THEN []::VARCHAR[] ELSE list_filter([{', '.join(cases)}], lambda f: f IS NOT NULL) END"


@query(f"""WITH p AS (SELECT p_partkey, [{", ".join(_HEAD_AT(i, 0) for i in range(_WIDE))}] AS a, [{", ".join(_HEAD_AT(i, 5) for i in range(_WIDE))}] AS b FROM part),
  h AS (SELECT p_partkey, list_transform(range(1, {_WIDE + 1}), lambda i: lower(CASE WHEN a[i] = '' OR (b[i] <> '' AND length(a[i]) > 50 AND length(b[i]) <= 50) THEN b[i] ELSE a[i] END)) AS h FROM p),
  c AS (SELECT p_partkey, list_transform(h, lambda x: {_able("x")}) AS able FROM h),
  f AS (SELECT p_partkey, list_reduce(list_prepend([]::VARCHAR[], able), lambda done, x: list_append(done, coalesce(list_filter(x, lambda f: NOT list_contains(done, f))[1], ''))) AS f FROM c),
  m AS (SELECT p_partkey, f, list_contains(f, 'company_name') AS wide FROM f),
  g AS (SELECT p_partkey, list_transform(range(1, {_WIDE + 1}), lambda i: CASE WHEN wide AND f[i] = '' AND i = 7 AND NOT list_contains(f, 'principal_amount') THEN 'principal_amount' WHEN wide AND f[i] = '' AND i = 8 AND NOT list_contains(f, 'amortized_cost') THEN 'amortized_cost'
    WHEN wide AND f[i] = '' AND i = 9 AND NOT list_contains(f, 'fair_value') THEN 'fair_value' ELSE f[i] END) AS g FROM m)
  SELECT p_partkey, array_to_string(g, ',') AS fields FROM g""")
def header_fields(spark, sf):
    """Two rows of heads merged and read as fields, column by column."""
    row = lambda shift: F.array(*[_pick(F.col("p_partkey") * (i + 3) + F.col("p_size") * (i * i + 1 + shift), _HEADS) for i in range(_WIDE)])
    p = dealt(spark, sf, "part", "p_partkey").select("p_partkey", grids.fields_of_heads(grids.merged_heads(row(0), row(5))).alias("m"))
    by_place = F.map_from_arrays(F.map_values("m"), F.map_keys("m"))
    shown = F.transform(F.sequence(F.lit(0), F.lit(_WIDE - 1)), lambda i: F.coalesce(F.try_element_at(by_place, i), F.lit("")))
    return p.select("p_partkey", F.array_join(shown, ",").alias("fields"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 2 = 0 THEN round(l_extendedprice, 2) END AS principal, CASE WHEN l_linenumber % 3 = 0 THEN -round(l_quantity, 2) ELSE round(l_quantity, 2) END AS cost,
  CASE WHEN l_linenumber % 5 = 0 THEN 0.0::DOUBLE ELSE round(l_quantity * 3, 2) END AS fair_value FROM lineitem""")
def money_rows(spark, sf):
    """Cells of a schedule's row: currency signs, brackets, dashes, a percentage behind; read by place from the end."""
    shown = lambda c: F.format_number(c, 2)
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    cost = F.when(n % 3 == 0, F.concat(F.lit("("), shown(q), F.lit(")"))).otherwise(shown(q))
    fair = F.when(n % 5 == 0, F.lit("—")).otherwise(shown(q * 3))
    cells = F.array(F.lit("Some Name"), F.when(n % 2 == 0, F.lit("$")), F.when(n % 2 == 0, shown("l_extendedprice")), F.lit(""), F.lit("USD"), cost, F.lit("$"), fair, F.lit("1.2%"))
    m = filings.money_cells(cells)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", m.alias("m")).select("l_orderkey", "l_linenumber", "l_partkey", "m.*")


@query("""WITH f AS (SELECT l_suppkey AS k, CASE l_linenumber % 3 WHEN 0 THEN 'FairValueDisclosure' WHEN 1 THEN 'AmortizedCostBasis' ELSE 'SharesHeld' END AS concept, l_extendedprice * CASE WHEN l_suppkey % 2 = 0 THEN 100 ELSE 1 END AS v,
    CASE WHEN l_suppkey % 3 = 0 AND l_linenumber = 1 THEN '-3' WHEN l_linenumber = 2 THEN 'INF' END AS d FROM lineitem),
  m AS (SELECT k, list_sort(list(v) FILTER (WHERE concept <> 'SharesHeld' AND v > 0)) AS s, coalesce(bool_or(d = '-3'), false) AS told FROM f GROUP BY 1)
  SELECT k, CASE WHEN s IS NULL THEN 1.0::DOUBLE WHEN told OR s[len(s) // 2 + 1] > 100000 THEN 1000.0::DOUBLE ELSE 1.0::DOUBLE END AS divisor FROM m""")
def decimals_scale(spark, sf):
    n, s = F.col("l_linenumber"), F.col("l_suppkey")
    concept = F.when(n % 3 == 0, "FairValueDisclosure").when(n % 3 == 1, "AmortizedCostBasis").otherwise("SharesHeld")
    told = F.when((s % 3 == 0) & (n == 1), "-3").when(n == 2, "INF")
    f = table(spark, sf, "lineitem").select(s.alias("k"), concept.alias("concept"), (F.col("l_extendedprice") * F.when(s % 2 == 0, 100).otherwise(1)).cast("string").alias("v"), told.alias("d"))
    return reconcile.decimals_divisor(f, ["k"], "concept", "v", "d")


@query("""WITH e AS (SELECT event_id, user_id % 20 AS co, CAST(floor(value / 10) AS BIGINT) AS fv, 2 + (CASE WHEN event_id % 2 = 0 THEN 4 ELSE 0 END) + (CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END) AS n FROM events),
  b AS (SELECT *, row_number() OVER (PARTITION BY co, fv ORDER BY n DESC, event_id) rn FROM e) SELECT event_id FROM b WHERE n > 5 OR rn = 1""")
def sparse_twins(spark, sf):
    """Two to seven of seven fields are filled; the sparse rows of a company and value go where a richer one is there."""
    some = [F.when(F.col("event_id") % 2 == 0, "x").alias(f"f{k}") for k in range(4)] + [F.when(F.col("event_id") % 3 == 0, "x").alias("f4"), F.lit("x").alias("f5"), F.lit("x").alias("f6")]
    e = table(spark, sf, "events").select("event_id", (F.col("user_id") % 20).alias("co"), F.floor(F.col("value") / 10).alias("fv"), *some)
    return filings.drop_sparse_twins(e, ["co", "fv"], [f"f{k}" for k in range(7)], "event_id").select("event_id")


@query("""WITH r AS (SELECT conv_id, turn, role, conv_id // 50 AS filing, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS place FROM conversations),
  s AS (SELECT filing, conv_id, string_agg(lower(role), '|' ORDER BY place) AS sig, count(*) n FROM r WHERE place <= 5 GROUP BY 1, 2), k AS (SELECT conv_id FROM (SELECT *, min(conv_id) OVER (PARTITION BY filing, sig) AS f FROM s WHERE n >= 3) WHERE conv_id > f)
  SELECT conv_id, turn FROM r WHERE conv_id NOT IN (SELECT conv_id FROM k)""")
def repeated_schedules(spark, sf):
    """A conversation is a table and its roles are the names; of a filing's tables that begin alike the first stays."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.floor(F.col("conv_id") / 50).alias("filing"))
    r = A.ranked(c, ["conv_id"], F.asc("turn"), F.asc("role"), name="place")
    return filings.drop_repeated_schedules(r, ["filing"], "conv_id", "place", "role").select("conv_id", "turn")


@query("""WITH a AS (SELECT event_id, user_id AS k, CAST(floor(value) AS BIGINT) AS v, CASE WHEN event_id % 3 = 0 THEN event_type ELSE '' END AS f FROM events), o AS (SELECT k, v, min(event_type) AS f FROM (SELECT user_id AS k, CAST(floor(value) AS BIGINT) AS v, event_type FROM events WHERE event_id % 2 = 0) GROUP BY 1, 2),
  p AS (SELECT k, min(f) AS f FROM o GROUP BY 1) SELECT event_id, coalesce(nullif(a.f, ''), o.f, p.f) AS f FROM a LEFT JOIN o ON a.k = o.k AND a.v = o.v LEFT JOIN p ON a.k = p.k""")
def enriched_rows(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("user_id").alias("k"), F.floor("value").alias("v"), "event_type")
    rows = e.withColumn("f", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(""))
    other = e.filter("event_id % 2 = 0").select("k", "v", F.col("event_type").alias("f"))
    return filings.enrich(rows.select("event_id", "k", "v", "f"), other, ["k"], "v", ["f"]).select("event_id", "f")


_ALIASES = {"cash": ["Cash", "CASH AND EQUIVALENTS"], "debt": ["Machinery", "Total  Debt"], "assets": ["Building", "Total assets"]}


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'debt' WHEN 'BUILDING' THEN 'assets' END AS metric, CASE WHEN c_name IN ('Customer#000000001', 'Customer#000000002') THEN 'First Two' ELSE c_name END AS canonical FROM customer")
def metric_keys(spark, sf):
    c = table(spark, sf, "customer")
    merged = filings.merge_canonical(F.col("c_name"), {"First Two": ["Customer#000000001", "Customer#000000002"]})
    return c.select("c_custkey", filings.metric_key(F.col("c_mktsegment"), _ALIASES).alias("metric"), merged.alias("canonical"))


@query("""SELECT o_orderkey, coalesce(i, e, f) AS "end", CASE WHEN i IS NOT NULL THEN 'instant' WHEN e IS NOT NULL THEN 'duration' ELSE 'filing' END AS type FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS i, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) - 5 END AS e, CAST(o_orderdate AS DATE) + 40 AS f FROM orders)""")
def statement_periods(spark, sf):
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    p = filings.period_of(F.when(k % 3 == 0, d), F.when(k % 2 == 0, F.date_sub(d, 5)), F.date_add(d, 40))
    return table(spark, sf, "orders").select("o_orderkey", p.alias("p")).select("o_orderkey", "p.*")


_SUFFIX_KINDS = ["First Lien", "Preferred Equity", "Warrants", "Revolver", "Other", "Subordinated Debt", ""]


@query(f"""WITH c AS (SELECT p_partkey, p_size % 4 AS k, {_BASE} || ' ' || {_sql_pick('p_partkey', _FORMS_WANT)} AS name, {_sql_pick('p_size', _SUFFIX_KINDS)} AS kind FROM part)
  SELECT p_partkey, name AS company_name, CASE WHEN k = 0 THEN 'Energy' WHEN k = 1 THEN 'Other' WHEN k = 2 THEN '' ELSE 'Healthcare' END AS industry, kind AS investment_type, 'SOFR' AS reference_rate, CASE WHEN k = 0 THEN '' ELSE '5.00%' END AS spread,
    CAST((name <> cell)::INT + CASE WHEN k = 0 THEN 1 ELSE 0 END + CASE WHEN k IN (1, 3) THEN 1 ELSE 0 END + 1 + CASE WHEN kind <> raw THEN 1 ELSE 0 END AS INTEGER) AS changed
  FROM (SELECT c.*, {_sql_pick('p_partkey + p_size', _LEADS)} || {_BASE} || ' ' || {_sql_pick('p_partkey', _FORMS)} || {_sql_pick('p_size', _TAILS)} AS cell, {_sql_pick('p_size', [s.strip(' -,') for s in _SUFFIXES])} AS raw FROM c JOIN part USING (p_partkey))""")
def standardized_rows(spark, sf):
    """The cleaning projection over whole rows: company, sector, instrument, rate and spread."""
    k = F.col("p_size") % 4
    p = dealt(spark, sf, "part", "p_partkey").join(company_cells(spark, sf), "p_partkey")
    rows = p.select(
        "p_partkey", F.col("cell").alias("company_name"), F.when(k == 0, "Energy").when(k == 1, "12.5%").when(k == 2, "").otherwise("Hospital services").alias("industry"),
        _pick(F.col("p_size"), [s.strip(" -,") for s in _SUFFIXES]).alias("investment_type"), F.lit("S +").alias("reference_rate"), F.when(k == 0, "2024-01-31").otherwise("5.00%").alias("spread"),
    )
    return filings.standardize(rows)


_X = "round((o_custkey % 900) / 100.0, 2)::DOUBLE"


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 3 THEN NULL WHEN o_orderkey % 5 = 4 THEN NULL ELSE ['SOFR', 'LIBOR', 'Prime'][o_orderkey % 5 + 1] END AS reference, CASE o_orderkey % 5 WHEN 0 THEN {_X} WHEN 1 THEN -{_X} WHEN 2 THEN 20 + o_custkey % 900 END::DOUBLE / CASE WHEN o_orderkey % 5 = 2 THEN 100 ELSE 1 END AS spread,
  CASE o_orderkey % 5 WHEN 0 THEN 0.75 WHEN 2 THEN 1.25 END::DOUBLE AS floor, CASE WHEN o_orderkey % 5 = 1 THEN 2.5 END::DOUBLE AS pik, CASE WHEN o_orderkey % 5 = 3 THEN {_X} END AS fixed FROM orders""")
def rate_cells_read(spark, sf):
    """Combined cells of rates: per cent with a floor, a negative spread with PIK, basis points with a named floor, a fixed rate, words alone."""
    k, x = F.col("o_orderkey") % 5, F.format_string("%.2f", F.round((F.col("o_custkey") % 900) / 100.0, 2))
    cell = F.when(k == 0, F.concat(F.lit("SOFR + "), x, F.lit("%, Floor 0.75%"))).when(k == 1, F.concat(F.lit("3-month LIBOR - "), x, F.lit("% / 2.5% PIK")))
    cell = cell.when(k == 2, F.concat(F.lit("P+ "), (F.col("o_custkey") % 900 + 20).cast("string"), F.lit(", 1.25% PRIME floor"))).when(k == 3, F.concat(x, F.lit("%"))).otherwise(F.lit("see note"))
    return dealt(spark, sf, "orders", "o_orderkey").select("o_orderkey", rates.parse(cell).alias("r")).select("o_orderkey", "r.*")


@query("""SELECT c_custkey, CASE WHEN k = 0 THEN a + 1 WHEN k = 1 THEN a END::DOUBLE AS cost_pct, CASE WHEN k IN (0, 2) THEN a END::DOUBLE AS fv_pct, CASE WHEN k = 0 THEN (1 + c_custkey % 12)::INTEGER END AS count, CASE WHEN k = 3 THEN 2.5 END::DOUBLE AS risk_rating,
  CASE k WHEN 0 THEN 'high' WHEN 3 THEN 'low' ELSE 'medium' END AS confidence FROM (SELECT c_custkey, c_custkey % 4 AS k, (c_custkey % 30) / 2.0 AS a FROM customer)""")
def credit_texts(spark, sf):
    """Sentences on non-accrual: two figures in order, one at cost, one excluded beside one at fair value, a rating alone."""
    k, a = F.col("c_custkey") % 4, (F.col("c_custkey") % 30) / 2.0
    low, high = F.format_string("%.1f", a), F.format_string("%.1f", a + 1)
    word = _pick(F.col("c_custkey"), list(credit.WORDS))
    said = F.when(k == 0, F.concat(F.lit("In 2024, "), word, F.lit(" companies were on non-accrual. Non-accrual loans were "), low, F.lit("% and "), high, F.lit("% at fair value and cost. Nothing else.")))
    said = said.when(k == 1, F.concat(F.lit("Our non-accrual loans came to "), low, F.lit("% at amortized cost. Other loans were 9% at fair value.")))
    said = said.when(k == 2, F.concat(F.lit("Income excluding non-accrual loans was 5% at cost. The non-accrual loans were "), low, F.lit("% of all at fair value.")))
    said = said.otherwise(F.lit("Nothing is on hold. The average risk rating of loans was 2.5."))
    return dealt(spark, sf, "customer", "c_custkey").select("c_custkey", credit.extract(said).alias("c")).select("c_custkey", "c.*")


@query("""WITH l AS (SELECT *, l_orderkey % 6 AS k FROM lineitem)
  SELECT l_orderkey, l_linenumber, 'S + 5.75%|1.00%' || CASE WHEN k = 5 THEN '|USD|' || CAST(CAST(l_linenumber AS BIGINT) AS VARCHAR) ELSE '' END AS rate,
    CASE WHEN k IN (0, 2) THEN strftime(l_shipdate, '%Y-%m-%d') WHEN k IN (1, 3) THEN strftime(l_shipdate, '%Y-%m') || '-01' END AS maturity,
    CASE WHEN k < 5 THEN CAST(l_quantity AS DOUBLE) END AS principal, CASE WHEN k < 5 THEN CAST(l_linenumber AS DOUBLE) END AS cost, CASE WHEN k < 5 THEN -CAST(l_quantity AS DOUBLE) END AS fair_value FROM l""")
def rows_around_maturity(spark, sf):
    """Lines as rows of cells: rate, maturity in five spellings or none, money with signs of currency and blanks between."""
    k = F.col("l_orderkey") % 6
    spelled = F.when(k == 0, F.date_format("l_shipdate", "M/d/yyyy")).when(k == 1, F.date_format("l_shipdate", "MM/yyyy")).when(k == 2, F.date_format("l_shipdate", "yyyy-MM-dd"))
    spelled = spelled.when(k == 3, F.date_format("l_shipdate", "MMMM yyyy")).when(k == 4, "N/A").otherwise("USD")
    text = lambda c: F.col(c).cast("double").cast("string")
    number = F.col("l_linenumber").cast("long").cast("string")
    cells = F.when(k == 5, F.array(F.lit("S + 5.75%"), F.lit(""), F.lit("1.00%"), spelled, number))
    cells = cells.otherwise(F.array(F.lit("S + 5.75%"), F.lit(""), F.lit("1.00%"), spelled, F.lit("$"), text("l_quantity"), F.lit(" "), number, F.concat(F.lit("("), text("l_quantity"), F.lit(")"))))
    r = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", filings.around_maturity(cells).alias("r"))
    return r.select("l_orderkey", "l_linenumber", F.array_join("r.rate", "|").alias("rate"), "r.maturity", "r.principal", "r.cost", "r.fair_value")


@query("""WITH e AS (SELECT o_custkey, o_orderkey, CASE WHEN o_totalprice < 60000 THEN 'h' WHEN o_totalprice > 250000 THEN 's' ELSE 't' END AS kind, o_orderpriority = '1-URGENT' AS prior, o_orderpriority = '2-HIGH' AS other FROM orders),
  m AS (SELECT *, max(CASE WHEN kind <> 't' THEN o_orderkey END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS at FROM e),
  p AS (SELECT m.*, h.kind = 'h' AS opened, coalesce(max(CASE WHEN m.kind = 't' AND m.prior THEN 1 ELSE 0 END) OVER (PARTITION BY m.o_custkey, m.at ORDER BY m.o_orderkey), 0) AS past FROM m LEFT JOIN e h ON h.o_orderkey = m.at),
  i AS (SELECT *, kind = 't' AND coalesce(opened, false) AND past = 0 AS inside FROM p), a AS (SELECT *, max(inside::INT) OVER (PARTITION BY o_custkey) AS n_inside FROM i)
  SELECT o_custkey, o_orderkey FROM a WHERE inside OR (n_inside = 0 AND kind = 't' AND other)""")
def tables_under_headings(spark, sf):
    """Orders as elements of a customer's filing: cheap ones head a schedule, dear ones end it, the others are tables."""
    kind = F.when(F.col("o_totalprice") < 60000, "h").when(F.col("o_totalprice") > 250000, "s").otherwise("t")
    e = table(spark, sf, "orders").select("o_custkey", "o_orderkey", kind.alias("kind"), "o_orderpriority")
    is_, of = lambda k: F.col("kind") == k, lambda p: F.col("o_orderpriority") == p
    return documents.under_headings(e, "o_custkey", "o_orderkey", is_("h"), is_("s"), is_("t"), of("1-URGENT"), of("2-HIGH")).select("o_custkey", "o_orderkey")


@query("""WITH c AS (SELECT *, 'T' || c_custkey AS ticker, c_custkey % 5 AS k FROM customer)
  SELECT ticker, CASE WHEN k IN (0, 1) THEN c_name WHEN k IN (2, 3) THEN 'Short ' || c_custkey ELSE ticker END AS name, CASE WHEN k = 0 THEN 'EUR' ELSE 'USD' END AS currency,
    CASE WHEN k < 4 THEN CAST(CASE WHEN k = 1 AND c_nationkey <> 0 THEN c_nationkey ELSE c_acctbal END AS DOUBLE) END AS current_price, CASE WHEN k < 4 THEN CAST(c_acctbal AS DOUBLE) END AS market_price, CASE WHEN k < 4 THEN CAST(c_nationkey AS DOUBLE) * 10 END AS book FROM c""")
def quotes_of_json(spark, sf):
    """Customers as market quotes in JSON; every fifth can't be read."""
    k = F.col("c_custkey") % 5
    name = F.concat(F.lit("Short "), F.col("c_custkey").cast("string"))
    body = F.struct(
        F.when(k < 2, F.col("c_name")).when(k == 2, "").alias("longName"), F.when(k > 0, name).alias("shortName"), F.when(k == 0, "EUR").alias("currency"), F.col("c_acctbal").cast("double").alias("regularMarketPrice"),
        F.when(k == 1, F.col("c_nationkey").cast("double")).alias("currentPrice"), (F.col("c_nationkey").cast("double") * 10).alias("bookValue"), F.array(F.lit(1)).alias("unknown"),
    )
    raw = table(spark, sf, "customer").select(F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"), F.when(k == 4, "{not json").otherwise(F.to_json(body)).alias("payload"))
    q = sources_facts.market_quotes(raw)
    return q.select("ticker", "name", "currency", "current_price", F.col("price.regularMarketPrice").alias("market_price"), F.col("summary.bookValue").alias("book"))
