"""Standardization, repair and removal of rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import parse, text, vocab
from ..operators import aggregate as A
from ..operators import dedup, joins, order, reconcile
from .binding import money, query, table


@query("""SELECT p_partkey, CASE WHEN p_size % 5 = 4 THEN NULL WHEN p_size % 2 = 0 THEN -round(p_retailprice, 2) ELSE round(p_retailprice, 2) END AS parsed FROM part""")
def parse_numbers(spark, sf):
    """Prices written as in accounts, read back."""
    p = table(spark, sf, "part")
    plain = F.format_number("p_retailprice", 2)
    cell = F.when(F.col("p_size") % 5 == 4, F.lit("n/a")).when(F.col("p_size") % 2 == 0, F.concat(F.lit("($"), plain, F.lit(")"))).otherwise(F.concat(F.lit(" $ "), plain, F.lit(" ")))
    return p.select("p_partkey", parse.to_double(cell).alias("parsed"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders")
def parse_dates(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey") % 3
    cell = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "M/d/yyyy")).otherwise(F.date_format("o_orderdate", "M/d/yy"))
    return o.select("o_orderkey", parse.parse_date(cell).alias("d"))


@query("""SELECT o_orderkey, CAST(date_trunc('quarter', CAST(o_orderdate AS DATE) + 1) - INTERVAL 1 DAY AS DATE) AS quarter_end, 'Q' || quarter(o_orderdate) || ' ' || year(o_orderdate) AS label FROM orders""")
def quarter_ends(spark, sf):
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select("o_orderkey", parse.quarter_end_before(d).alias("quarter_end"), parse.quarter_label(d).alias("label"))


def _pick(key, values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def _sql_pick(key, values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"][CAST(({key}) % {len(values)} + 1 AS INT)]"


def _sql_first(cell, rules, otherwise):
    """CASE over (label, pattern) rules, for DuckDB."""
    return "CASE " + " ".join(f"WHEN regexp_matches({cell}, '{p}') THEN '{x}'" for x, p in rules) + f" ELSE {otherwise} END"


# Cells are made of the tables' own columns: a rank and a form by size and brand around the part's type and name.
_RANKS = ["First Lien", "2nd lien", "Senior Secured", "Unsecured", "Subordinated", "Preferred", "Common", "Delayed Draw", "Warrants for", "Revolving", "Partnership", "Mezzanine", ""]
_FORMS = ["Term Loan", "stock", "Units", "notes", "Shares", "", "equity"]
_BRAND = "CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT)"
_TYPE_CELL = f"trim({_sql_pick('p_size', _RANKS)} || ' ' || p_type || ' ' || {_sql_pick(_BRAND, _FORMS)})"


def _plain_type_sql(cell):
    has = lambda *w: " OR ".join(f"contains({cell}, '{x}')" for x in w)
    paper = has("equity", "stock", "unit", "share")
    rules = [
        (has("delayed draw", "ddtl"), "Delayed Draw"), (has("revolv"), "Revolver"), (has("second lien", "2nd lien"), "Second Lien"), (has("first lien", "1st lien", "senior secured"), "First Lien"),
        (has("subordinated", "mezzanine"), "Subordinated Debt"), (has("unsecured"), "Unsecured Debt"), (has("warrant"), "Warrants"), (f"{has('preferred')} AND ({paper})", "Preferred Equity"),
        (f"{has('common')} AND ({paper})", "Common Equity"), (has("partnership", "member interest"), "Partnership Interest"), (has("equity", "stock", "share"), "Other Equity"), (has("debt", "loan", "note", "bond"), "Other Debt"),
    ]
    return "CASE " + " ".join(f"WHEN {c} THEN '{x}'" for c, x in rules) + " ELSE 'Other' END"


@query(f"SELECT p_partkey, cell, {_plain_type_sql('lower(cell)')} AS kind FROM (SELECT p_partkey, {_TYPE_CELL} AS cell FROM part)")
def standardize_type(spark, sf):
    p = table(spark, sf, "part")
    brand = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
    cell = F.trim(F.concat_ws(" ", _pick(F.col("p_size"), _RANKS), "p_type", _pick(brand, _FORMS)))
    return p.select("p_partkey", cell.alias("cell")).withColumn("kind", text.instrument_type(F.col("cell")))


# A rate cell: a name and a tenor by the order's key, a sign and figures from its price.
_RATES = ["SOFR", "S +", "Libor", "L+", "Euribor", "base rate", "2024#SoniaMember", "2024#NoMember", "n/a", "", "Federal Funds", "Prime", "1M Term SOFR", "E + 500", "BBSY", "p"]
_TENORS = ["", " (Q)", " (M)", ""]
_RATE_CELL = f"{_sql_pick('o_orderkey', _RATES)} || {_sql_pick('o_custkey', _TENORS)}"
_NAMES_SQL = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in vocab.RATE_NAMES.items()) + "}"
_MEMBERS_SQL = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in vocab.RATE_MEMBERS.items()) + "}"


def rate_cells(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.concat(_pick(F.col("o_orderkey"), _RATES), _pick(F.col("o_custkey"), _TENORS)).alias("cell"))


@query(rf"""WITH c AS (SELECT o_orderkey, {_RATE_CELL} AS cell FROM orders), k AS (SELECT *, replace(replace(lower(trim(cell)), '+', ''), ' ', '') AS bare FROM c)
  SELECT o_orderkey, cell, CASE WHEN trim(cell) = '' THEN '' WHEN contains(cell, '#') THEN coalesce({_MEMBERS_SQL}[lower(split_part(cell, '#', -1))], '')
    ELSE coalesce({_NAMES_SQL}[bare], {_NAMES_SQL}[split_part(bare, '(', 1)], CASE WHEN lower(trim(cell)) IN ('n/a', 'na', 'none', '-') THEN 'N/A' END, cell) END AS rate,
    CASE WHEN upper(trim(cell)) IN ('', 'N/A', 'NA', 'NONE', '-', '—', '0') THEN NULL WHEN contains(upper(cell), 'SOFR') THEN 'SOFR' WHEN contains(upper(cell), 'LIBOR') OR regexp_matches(upper(trim(cell)), '^L\s*[+-]') THEN 'LIBOR'
      WHEN contains(upper(cell), 'EURIBOR') OR regexp_matches(upper(trim(cell)), '^E\s*\+') THEN 'EURIBOR' WHEN contains(upper(cell), 'PRIME') OR regexp_matches(upper(trim(cell)), '^P\s*\+') THEN 'Prime' WHEN contains(upper(cell), 'SONIA') THEN 'SONIA'
      WHEN contains(upper(cell), 'CDOR') THEN 'CDOR' WHEN contains(upper(cell), 'BBSY') THEN 'BBSY' WHEN contains(upper(cell), 'CORRA') THEN 'CORRA' WHEN contains(upper(cell), 'FIXED') THEN 'Fixed' WHEN contains(upper(cell), 'BASE RATE') THEN 'Base rate' ELSE 'Other' END AS benchmark FROM k""")
def standardize_rate(spark, sf):
    """The rate's standard name, and its benchmark."""
    return rate_cells(spark, sf).select("o_orderkey", "cell", text.reference_rate(F.col("cell")).alias("rate"), text.benchmark(F.col("cell")).alias("benchmark"))


# Figures to two places, exact halves up: counted in whole hundredths, as printf would round the binary value.
@query("""WITH o AS (SELECT *, (CAST(round(o_totalprice * 100) AS BIGINT) + 20000) // 40000 AS h FROM orders),
  c AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN printf('%d.%02d%%', h // 100, h % 100) WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, '%m/%Y') WHEN 3 THEN upper(split_part(o_orderpriority, '-', 2)) ELSE 'SOFR (M)' END AS cell FROM o)
  SELECT o_orderkey, cell, CASE WHEN regexp_matches(cell, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') OR regexp_matches(cell, '^[0-9]{1,2}/[0-9]{4}') OR cell = 'SOFR (M)' THEN '' ELSE cell END AS spread FROM c""")
def clean_spreads(spark, sf):
    """Spread cells that hold figures (two places, halves up), dates, months, priorities and rate names."""
    k = F.col("o_orderkey") % 5
    cell = F.when(k == 0, F.format_string("%.2f%%", F.col("o_totalprice") / 40000)).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 2, F.date_format("o_orderdate", "MM/yyyy"))
    cell = cell.when(k == 3, F.upper(F.split("o_orderpriority", "-")[1])).otherwise("SOFR (M)")
    return table(spark, sf, "orders").select("o_orderkey", cell.alias("cell")).withColumn("spread", text.clean_spread(F.col("cell")))


# Industry cells: the customer's segment with a second word by nation, and other cells by key.
_TRADES = [
    "", "Health Care Providers", "software", "Telecom services", "Agriculture", "Wholesale", "steel works", "legal", "FIRE: Insurance", "FIRE: Banking", "Services: Consumer", "Services Business", "Road",
    "Communications", "12.5%", "(In thousands)", "first lien", "cash equivalents - 6.6 %", "Cash", "wellness", "pet food", "Diversified holdings", "Oil &amp; Gas", "Basket weaving", "Bidco loan (EUR 2,511 par, due 4/2031)", "Joint venture",
]
_SEGMENT_CELL = f"CASE WHEN c_custkey % 3 = 0 THEN {_sql_pick('c_nationkey', _TRADES)} WHEN c_custkey % 3 = 1 THEN lower(c_mktsegment) ELSE trim(c_mktsegment || ' ' || {_sql_pick('c_nationkey + c_custkey', _TRADES)}) END"


def _sector_sql(cell):
    low = f"replace(lower(trim({cell})), '&amp;', '&')"
    none = [f"length(trim({cell})) > 80", f"{low} IN ('', " + ", ".join(f"'{x}'" for x in vocab.NO_INDUSTRY) + ")", *[f"regexp_matches({low}, '{p}')" for p in vocab.NOT_INDUSTRY]]
    words = "CASE " + " ".join("WHEN " + " OR ".join("contains({0}, '{1}')".format(low, w.replace("'", "''")) for w in vocab.SECTOR_WORDS[x]) + f" THEN '{x}'" for x in vocab.SECTOR_WORDS) + f" ELSE trim({cell}) END"
    prefix = " ".join(f"WHEN regexp_matches({low}, '{p}') THEN '{x}'" for p, x in vocab.SECTOR_PREFIXES)
    names = " ".join(f"WHEN {low} = '{k}' THEN '{x}'" for k, x in vocab.SECTOR_NAMES.items())
    return f"CASE WHEN {' OR '.join(none)} THEN '' {prefix} {names} ELSE {words} END"


@query(f"""WITH c AS (SELECT c_custkey, {_SEGMENT_CELL} AS cell FROM customer), k AS (SELECT cell, {_sector_sql('cell')} AS sector FROM (SELECT DISTINCT cell FROM c))
  SELECT c_custkey, c.cell, sector, CASE WHEN sector = '' AND trim(c.cell) <> '' THEN 'Other' ELSE sector END AS standard FROM c JOIN k ON c.cell = k.cell""")
def standardize_sector(spark, sf):
    """Distinct cells are few, so the cascade runs on them once and the labels are joined back."""
    c = F.col("c_custkey") % 3
    cell = F.when(c == 0, _pick(F.col("c_nationkey"), _TRADES)).when(c == 1, F.lower("c_mktsegment"))
    cell = cell.otherwise(F.trim(F.concat_ws(" ", "c_mktsegment", _pick(F.col("c_nationkey") + F.col("c_custkey"), _TRADES))))
    p = table(spark, sf, "customer").select("c_custkey", cell.alias("cell"))
    labels = p.select("cell").distinct().select("cell", text.sector(F.col("cell")).alias("sector"), text.standard_sector(F.col("cell")).alias("standard"))
    return p.join(labels, "cell").select("c_custkey", "cell", "sector", "standard")


@query("""SELECT o_orderkey, array_to_string(list_sort(list_distinct(list_concat(CASE WHEN o_orderstatus = 'O' THEN ['open'] ELSE [] END, list_concat(CASE WHEN o_totalprice > 200000 THEN ['large'] ELSE [] END, CASE WHEN o_orderpriority = '1-URGENT' THEN ['open', 'urgent'] ELSE [] END)))), '|') AS flags FROM orders""")
def merge_flags(spark, sf):
    """Flags that a row has and flags that rules add: a sorted set in one cell."""
    o = table(spark, sf, "orders")
    has = F.when(F.col("o_orderpriority") == "1-URGENT", "open|urgent").otherwise("")
    new = F.array_compact(F.array(F.when(F.col("o_orderstatus") == "O", "open"), F.when(F.col("o_totalprice") > 200000, "large")))
    both = F.array_sort(F.array_union(F.filter(F.split(has, r"\|"), lambda x: x != ""), new))
    return o.select("o_orderkey", F.array_join(both, "|").alias("flags"))


@query("""WITH v AS (SELECT event_id, event_type, CASE WHEN event_id % 500 = 3 THEN value * 100000 ELSE value END AS v FROM events),
  m AS (SELECT event_type, list_sort(list(v))[count(v) // 2 + 1] AS med, count(v) n FROM v GROUP BY 1) SELECT event_id, CASE WHEN n >= 5 AND v > 500 * med THEN NULL ELSE v END AS v FROM v JOIN m USING (event_type)""")
def clear_outliers(spark, sf):
    v = F.when(F.col("event_id") % 500 == 3, F.col("value") * 100_000).otherwise(F.col("value"))
    e = table(spark, sf, "events").select("event_id", "event_type", v.alias("v"))
    return reconcile.clear_outliers(e, ["event_type"], "v").select("event_id", "v")


@query("""WITH v AS (SELECT user_id, value * CASE user_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 1e6 WHEN 2 THEN 1e9 ELSE 1e12 END AS v FROM events), m AS (SELECT user_id, median(v) AS med, count(*) n FROM v WHERE v > 0 GROUP BY 1)
  SELECT user_id, CASE WHEN n >= 10 AND med > 1e6 THEN pow(0.001, least(4, ceil(log10(med / 1e6) / 3))) ELSE 1 END AS factor FROM m""")
def unit_repair(spark, sf):
    v = F.col("value") * F.element_at(F.array(*[F.lit(x) for x in (1.0, 1e6, 1e9, 1e12)]), (F.col("user_id") % 4 + 1).cast("int"))
    m = table(spark, sf, "events").select("user_id", v.alias("v")).filter("v > 0").groupBy("user_id").agg(F.median("v").alias("med"), F.count("v").alias("n"))
    return m.select("user_id", F.when(F.col("n") >= 10, reconcile.unit_factor(F.col("med"))).otherwise(1.0).alias("factor"))


@query("SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def exact_dedup(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").dropDuplicates()


@query("""WITH e AS (SELECT user_id, event_type, event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS a, CASE WHEN event_id % 5 = 0 THEN '' ELSE props END AS b FROM events)
  SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY (a IS NOT NULL)::INT + (b <> '')::INT DESC, event_id) rn FROM e) WHERE rn = 1""")
def keep_richest(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("a"), F.when(F.col("event_id") % 5 == 0, "").otherwise(F.col("props")).alias("b"))
    return dedup.keep_richest(e, ["user_id", "event_type"], ["a", "b"], F.col("event_id")).select("user_id", "event_type", "event_id")


@query()
def drop_close_values(spark, sf):
    """Rows only: greedy in order, held against a plain loop in the tests."""
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return dedup.drop_close(e, ["user_id", "event_type"], "value", "event_id", 0.75)


@query()
def later_positions(spark, sf):
    """Rows only: lines are positions of a supplier's schedule, held against loops over pairs in the tests."""
    n = F.col("l_linenumber")
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("Supplier "), (F.col("l_suppkey") % 50).cast("string"), F.when(n % 2 == 0, " (1)").otherwise("")).alias("company"), F.concat("l_returnflag", "l_linestatus").alias("kind"),
        F.when(n % 5 != 0, F.format_number("l_extendedprice", 2)).alias("principal"), F.when(n % 3 != 0, F.date_format("l_shipdate", "M/d/yyyy")).alias("maturity"),
        F.when(n % 7 != 0, F.col("l_quantity").cast("string")).otherwise("-").alias("cost"), F.when(F.col("l_tax") > 0.04, "x").alias("note"), (F.col("l_orderkey") % 9).alias("size"),
    )
    return dedup.drop_worse_positions(li, "company", "kind", "principal", "maturity", ["principal", "cost"], ["principal", "maturity", "cost", "note"], "size")


@query("""WITH e AS (SELECT *, event_id % 4 <> 0 AS has FROM events), f AS (SELECT DISTINCT user_id, event_type FROM e WHERE has) SELECT event_id FROM e LEFT JOIN f USING (user_id, event_type) WHERE has OR f.user_id IS NULL""")
def drop_shadows(spark, sf):
    e = table(spark, sf, "events")
    return joins.drop_shadows(e, ["user_id", "event_type"], F.col("event_id") % 4 != 0).select("event_id")


@query("""WITH n AS (SELECT p_partkey, p_brand, CASE WHEN p_size <= 10 THEN p_name WHEN p_size <= 30 THEN p_name || ' - ' || p_type ELSE p_name || ' - ' || p_type || ' - ' || p_size END AS name FROM part)
  SELECT p_partkey, name FROM n a WHERE NOT EXISTS (SELECT 1 FROM n b WHERE a.p_brand = b.p_brand AND starts_with(b.name, a.name || ' - '))""")
def drop_rollups(spark, sf):
    name = F.when(F.col("p_size") <= 10, F.col("p_name")).when(F.col("p_size") <= 30, F.concat_ws(" - ", "p_name", "p_type")).otherwise(F.concat_ws(" - ", "p_name", "p_type", F.col("p_size").cast("string")))
    p = table(spark, sf, "part").select("p_partkey", "p_brand", name.alias("name"))
    return joins.drop_rollups(p, ["p_brand"], "name").select("p_partkey", "name")


@query("""WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN role END AS role FROM conversations) SELECT conv_id, turn, last_value(role IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS role FROM c""")
def forward_fill(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 == 0, F.col("role")).alias("role"))
    return order.forward_fill(c, ["conv_id"], ["turn"], ["role"])


@query("""WITH a AS (SELECT user_id, CAST(ts AS DATE) AS d, max(value) v, 0 AS r FROM events WHERE event_type = 'purchase' GROUP BY 1, 2), b AS (SELECT user_id, CAST(ts AS DATE) AS d, max(value) v, 1 AS r FROM events WHERE event_type = 'view' GROUP BY 1, 2)
  SELECT user_id, d, v, r FROM (SELECT *, row_number() OVER (PARTITION BY user_id, d ORDER BY r) rn FROM (SELECT * FROM a UNION ALL SELECT * FROM b)) WHERE rn = 1""")
def prefer_source(spark, sf):
    """A union in which, for each user and day, the preferred source replaces the other."""
    e = table(spark, sf, "events").withColumn("d", F.col("ts").cast("date"))
    side = lambda t, r: e.filter(F.col("event_type") == t).groupBy("user_id", "d").agg(F.max("value").alias("v")).withColumn("r", F.lit(r))
    return dedup.keep_best(side("purchase", 0).unionByName(side("view", 1)), ["user_id", "d"], F.col("r"))


@query("""WITH s AS (SELECT user_id, date_trunc('week', ts) AS w, list(DISTINCT event_type) AS k FROM events GROUP BY 1, 2), p AS (SELECT user_id, w, k, lag(k) OVER (PARTITION BY user_id ORDER BY w) AS b FROM s)
  SELECT user_id, CAST(w AS DATE) AS w, round(len(list_intersect(k, b)) * 1.0::DOUBLE / len(list_distinct(list_concat(k, b))), 6) AS jaccard FROM p WHERE b IS NOT NULL""")
def jaccard_of_periods(spark, sf):
    s = table(spark, sf, "events").groupBy("user_id", F.to_date(F.date_trunc("week", "ts")).alias("w")).agg(F.collect_set("event_type").alias("k"))
    p = order.previous(s, ["user_id"], "w", ["k"]).filter("prev_k is not null")
    return p.select("user_id", "w", F.round(F.size(F.array_intersect("k", "prev_k")) / F.size(F.array_union("k", "prev_k")), 6).alias("jaccard"))


@query(f"SELECT p_type AS value, count(*) n FROM part WHERE p_type NOT IN ({', '.join(repr(t) for t in vocab.TYPES)}) GROUP BY 1 ORDER BY n DESC, value LIMIT 20")
def non_canonical(spark, sf):
    known = spark.createDataFrame([(t,) for t in vocab.TYPES], "value string")
    v = table(spark, sf, "part").select(F.col("p_type").alias("value")).join(known, "value", "left_anti")
    return v.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(20)


@query("""WITH t AS (SELECT user_id, CAST(sum(CAST(round(value, 4) AS DECIMAL(18,4))) AS DOUBLE) / 40 AS s FROM events GROUP BY 1) SELECT user_id, s AS total, CASE WHEN s > 500 THEN 1000.0::DOUBLE WHEN s > 150 THEN 100.0::DOUBLE ELSE 1.0::DOUBLE END AS divisor FROM t""")
def percent_scale(spark, sf):
    """Shares of net assets that add up to far more than all: by how much they are too large."""
    t = table(spark, sf, "events").groupBy("user_id").agg((F.sum(money(F.col("value"))).cast("double") / 40).alias("total"))
    return t.withColumn("divisor", reconcile.percent_divisor(F.col("total")))


@query("SELECT conv_id, turn, CAST((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 3 AS BIGINT) AS chunk FROM conversations")
def chunk_rows(spark, sf):
    return order.chunks(table(spark, sf, "conversations").select("conv_id", "turn"), ["conv_id"], ["turn"], 3)


@query("""WITH c AS (SELECT conv_id, turn, max((length(text) > 900)::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hit FROM conversations), k AS (SELECT *, sum((hit = 0)::INT) OVER (PARTITION BY conv_id) AS kept FROM c) SELECT conv_id, turn FROM k WHERE hit = 0 OR kept = 0""")
def take_until_first(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.length("text").alias("n"))
    return order.take_until(c, ["conv_id"], "turn", F.col("n") > 900).select("conv_id", "turn")


@query("""SELECT user_id, count(*) n, round(avg((value > 50)::INT) * 0.8 + least(1, count(*) / 10.0) * 0.2, 6) AS confidence FROM events GROUP BY 1""")
def confidence_score(spark, sf):
    e = table(spark, sf, "events").groupBy("user_id")
    n = F.count(F.lit(1))
    return e.agg(n.alias("n"), F.round(F.avg((F.col("value") > 50).cast("int")) * 0.8 + F.least(F.lit(1.0), n / 10.0) * 0.2, 6).alias("confidence"))


@query("""WITH t AS (SELECT l_returnflag, l_linestatus, CAST(sum(CAST(round(l_quantity, 4) AS DECIMAL(18,4))) AS DOUBLE) q, count(*) n FROM lineitem GROUP BY 1, 2) SELECT l_returnflag, l_linestatus, q, n, round(q / sum(q) OVER () * 100, 4) AS pct, rank() OVER (ORDER BY q DESC) AS rank FROM t""")
def quantity_profile(spark, sf):
    t = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum(money(F.col("l_quantity"))).cast("double").alias("q"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()
    return A.with_share(t, [], "q", "pct").withColumns({"pct": F.round("pct", 4), "rank": F.rank().over(w.orderBy(F.desc("q"))).cast("long")})
