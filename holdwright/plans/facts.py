"""Statement facts and filings. Orders stand in for facts (a customer's reported value at an
order date) and lines for positions; the events are filings of users."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import parse
from ..operators import aggregate as A
from ..operators import dedup, joins, order, reconcile, statements
from .binding import HOLDINGS, holdings, money, query, table

_MONEY = "CAST(round({0}, 4) AS DECIMAL(18,4))"


def series(spark, sf):
    """Quarterly values of every market segment: one row per segment and quarter end."""
    j = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    price = money(F.col("o_totalprice"))
    status = lambda s: F.sum(F.when(F.col("o_orderstatus") == s, price))
    q = j.groupBy(F.col("c_mktsegment").alias("entity"), F.date_sub(F.add_months(F.trunc("o_orderdate", "quarter"), 3), 1).alias("end"))
    return q.agg(F.sum(price).cast("double").alias("nav"), status("O").cast("double").alias("nii"), status("F").cast("double").alias("debt"), F.countDistinct("o_custkey").alias("shares"))


SERIES = """
WITH s AS (SELECT c_mktsegment AS entity, CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS "end",
    CAST(sum(m) AS DOUBLE) nav, CAST(sum(m) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) nii, CAST(sum(m) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) debt, count(DISTINCT o_custkey) shares
  FROM (SELECT *, CAST(round(o_totalprice, 4) AS DECIMAL(18,4)) AS m FROM orders) JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
"""


@query(SERIES + """SELECT entity, "end", debt / nullif(nav, 0) AS debt_to_equity, nav / nullif(debt, 0) AS asset_coverage, nav / nullif(shares, 0) AS nav_per_share, nii / nullif(shares, 0) AS nii_per_share FROM s""")
def derived_metrics(spark, sf):
    """Ratios of sums, unrounded: one division of equal doubles gives equal doubles."""
    r = lambda a, b: parse.safe_ratio(F.col(a), F.col(b))
    return series(spark, sf).select("entity", "end", r("debt", "nav").alias("debt_to_equity"), r("nav", "debt").alias("asset_coverage"), r("nav", "shares").alias("nav_per_share"), r("nii", "shares").alias("nii_per_share"))


@query(SERIES + """, p AS (SELECT *, lag("end") OVER w AS pe, lag(nav / shares) OVER w AS pn FROM s WINDOW w AS (PARTITION BY entity ORDER BY "end"))
  SELECT entity, "end", CASE WHEN "end" - pe BETWEEN 70 AND 110 THEN round(((nav / shares - pn) + nii / shares / 10) * 100 / pn, 6) END AS return_pct FROM p""")
def nav_total_return(spark, sf):
    s = series(spark, sf).withColumn("nps", F.col("nav") / F.col("shares"))
    s = order.previous(s, ["entity"], "end", ["end", "nps"])
    gained = ((F.col("nps") - F.col("prev_nps")) + F.col("nii") / F.col("shares") / 10) * 100 / F.col("prev_nps")
    return s.select("entity", "end", F.when(F.datediff("end", "prev_end").between(70, 110), F.round(gained, 6)).alias("return_pct"))


@query(SERIES + """, p AS (SELECT *, lag("end") OVER w AS pe, lag(nav / shares) OVER w AS pn FROM s WINDOW w AS (PARTITION BY entity ORDER BY "end")),
  r AS (SELECT entity, "end", CASE WHEN "end" - pe BETWEEN 70 AND 110 THEN round(((nav / shares - pn) + nii / shares / 10) * 100 / pn, 6) END AS x FROM p),
  k AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY "end" DESC) rn FROM r WHERE x IS NOT NULL)
  SELECT entity, CASE WHEN count(*) = 4 THEN round((product(1 + x / 100) - 1) * 100, 4) END AS compounded FROM k WHERE rn <= 4 GROUP BY 1""")
def compounded_4q_return(spark, sf):
    c = order.compounded(nav_total_return(spark, sf), ["entity"], "end", "return_pct", 4)
    return c.withColumn("compounded", F.round("compounded", 4))


@query(SERIES + """, n AS (SELECT entity, "end", nav, CASE WHEN shares % 3 <> 0 THEN nii END AS nii, CASE WHEN shares % 5 = 0 THEN debt END AS debt FROM s)
  SELECT entity, max("end") AS latest, max_by(nav, "end") nav, max_by(nii, "end") FILTER (WHERE nii IS NOT NULL) nii, max_by(debt, "end") FILTER (WHERE debt IS NOT NULL) debt FROM n GROUP BY 1""")
def latest_nonnull(spark, sf):
    s = series(spark, sf).withColumn("nii", F.when(F.col("shares") % 3 != 0, F.col("nii"))).withColumn("debt", F.when(F.col("shares") % 5 == 0, F.col("debt")))
    return s.groupBy("entity").agg(F.max("end").alias("latest"), *order.latest_known(["nav", "nii", "debt"], "end"))


@query(SERIES + """, n AS (SELECT entity, "end", CASE WHEN shares % 3 <> 0 THEN shares END AS shares FROM s),
  l AS (SELECT *, last_value(shares IGNORE NULLS) OVER (PARTITION BY entity ORDER BY "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM n)
  SELECT entity, "end", shares, shares - p AS change, round((shares - p) * 100.0::DOUBLE / p, 6) AS change_pct, coalesce(abs((shares - p) * 100.0::DOUBLE / p) > 25, false) AS abrupt FROM l""")
def share_change(spark, sf):
    s = series(spark, sf).select("entity", "end", F.when(F.col("shares") % 3 != 0, F.col("shares")).alias("shares"))
    c = order.change_since_known(s, ["entity"], "end", "shares")
    return c.withColumn("abrupt", F.coalesce(F.abs("change_pct") > 25, F.lit(False))).withColumn("change_pct", F.round("change_pct", 6))


@query(SERIES + """SELECT entity, "end", abs(nav - (debt + nii)) <= greatest(1, 0.03 * abs(nav)) AS balanced FROM s""")
def balance_check(spark, sf):
    return series(spark, sf).select("entity", "end", reconcile.balanced(F.col("nav"), F.col("debt") + F.col("nii")).alias("balanced"))


@query(SERIES + """, l AS (SELECT entity, max("end") AS "end" FROM s GROUP BY 1), v AS (SELECT s.entity, nav / shares AS nps, nii / shares AS yield, debt / nav AS lev FROM s JOIN l ON s.entity = l.entity AND s."end" = l."end")
  SELECT entity, round(90000 / nps, 6) AS p_nav, round((90000 / nps - 1) * 100, 4) AS premium_pct, round(yield * 400 / 90000, 4) AS yield_pct,
    concat_ws(',', CASE WHEN 90000 / nps < 0.8 THEN 'discount' END, CASE WHEN yield * 400 / 90000 > 20 THEN 'yield' END, CASE WHEN lev < 0.35 THEN 'leverage' END) AS flags FROM v""")
def valuation_snapshot(spark, sf):
    s = A.latest(series(spark, sf), ["entity"], "end")
    ratio = 90000 / (F.col("nav") / F.col("shares"))
    yields = F.col("nii") / F.col("shares") * 400 / 90000
    flags = F.concat_ws(",", F.when(ratio < 0.8, "discount"), F.when(yields > 20, "yield"), F.when(F.col("debt") / F.col("nav") < 0.35, "leverage"))
    return s.select("entity", F.round(ratio, 6).alias("p_nav"), F.round((ratio - 1) * 100, 4).alias("premium_pct"), F.round(yields, 4).alias("yield_pct"), flags.alias("flags"))


DAYS = [90, 181, 272, 364]
_QUARTERS = f"""WITH f AS (SELECT o_custkey % 500 AS entity, o_orderkey AS id, CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS "end", {DAYS}[CAST(o_orderkey % 4 + 1 AS INT)] AS days,
    CAST(o_orderdate AS DATE) AS filed, CAST(round(o_totalprice, 4) AS DECIMAL(18,4)) AS val FROM orders),
  c AS (SELECT *, CASE WHEN days BETWEEN 75 AND 100 THEN 0 WHEN days BETWEEN 170 AND 195 THEN 1 WHEN days BETWEEN 255 AND 290 THEN 2 ELSE 3 END AS p FROM f),
  l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, "end", p ORDER BY filed DESC, id DESC) rn FROM c) WHERE rn = 1),
  b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, "end" ORDER BY p) r2 FROM l) WHERE r2 = 1),
  j AS (SELECT b.*, s.val AS short, row_number() OVER (PARTITION BY b.entity, b."end" ORDER BY b."end" - s."end") r3 FROM b LEFT JOIN l s ON b.entity = s.entity AND s.p = b.p - 1 AND b."end" - s."end" BETWEEN 70 AND 110),
  q AS (SELECT entity, "end", CAST(CASE WHEN short IS NULL THEN val ELSE val - short END AS DOUBLE) AS val, CAST(CASE WHEN short IS NULL THEN days ELSE 90 END AS INTEGER) AS days, CASE WHEN short IS NOT NULL THEN ['H1-Q1', '9M-H1', 'FY-9M'][p] END AS derived FROM j WHERE r3 = 1) """


def quarters(spark, sf):
    """An order is a fact of 500 entities, over a quarter, half, nine months or year that ends with its quarter."""
    o = table(spark, sf, "orders")
    days = F.element_at(F.array(*[F.lit(d) for d in DAYS]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    end = F.date_sub(F.add_months(F.trunc("o_orderdate", "quarter"), 3), 1)
    f = o.select((F.col("o_custkey") % 500).alias("entity"), F.col("o_orderkey").alias("id"), end.alias("end"), days.alias("days"), F.col("o_orderdate").cast("date").alias("filed"), money(F.col("o_totalprice")).alias("val"))
    return statements.discrete_quarters(f, ["entity"], "end", "days", "val", "filed", "id").withColumn("val", F.col("val").cast("double"))


@query(_QUARTERS + "SELECT * FROM q")
def quarter_derivation(spark, sf):
    return quarters(spark, sf).select("entity", "end", "val", "days", "derived")


@query(_QUARTERS + """, r AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY "end" DESC) k FROM q) SELECT entity, """ + ", ".join(f"max(CASE WHEN k = {k} THEN val END) AS q{k}" for k in range(1, 9)) + " FROM r GROUP BY 1")
def statement_matrix(spark, sf):
    return statements.last_periods(quarters(spark, sf), ["entity"], "end", "val", 8)


@query("""WITH f AS (SELECT o_custkey % 50 AS entity, CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS "end", o_orderpriority AS form, CAST(o_orderdate AS DATE) AS filed, o_orderkey AS id FROM orders)
  SELECT entity, "end", form, filed FROM (SELECT *, row_number() OVER (PARTITION BY entity, "end" ORDER BY form, id) rn FROM f) WHERE rn = 1""")
def period_union(spark, sf):
    """Every period of any series, with form and date from the first series (here by priority) that has it."""
    end = F.date_sub(F.add_months(F.trunc("o_orderdate", "quarter"), 3), 1)
    f = table(spark, sf, "orders").select((F.col("o_custkey") % 50).alias("entity"), end.alias("end"), F.col("o_orderpriority").alias("form"), F.col("o_orderdate").cast("date").alias("filed"), "o_orderkey")
    return dedup.keep_best(f, ["entity", "end"], F.col("form"), F.col("o_orderkey")).select("entity", "end", "form", "filed")


@query("""WITH f AS (SELECT c_custkey % 40 AS label, c_custkey AS seq, CASE WHEN c_nationkey % 2 = 0 THEN 'USD/shares' ELSE 'USD' END AS unit, c_acctbal / 100 AS val FROM customer), u AS (SELECT label, arg_min(unit, seq) AS unit FROM f GROUP BY 1)
  SELECT f.label, seq, val FROM f JOIN u ON f.label = u.label WHERE NOT (u.unit = 'USD/shares' AND abs(val) > 50)""")
def per_share_guard(spark, sf):
    unit = F.when(F.col("c_nationkey") % 2 == 0, "USD/shares").otherwise("USD")
    f = table(spark, sf, "customer").select((F.col("c_custkey") % 40).alias("label"), F.col("c_custkey").alias("seq"), unit.alias("unit"), (F.col("c_acctbal") / 100).alias("val"))
    return statements.per_share_guard(f, ["label"], "seq", "unit", "val").select("label", "seq", "val")


@query("SELECT l_orderkey, l_linenumber, round_even(l_quantity * 0.125, 2) AS rounded, round_even(l_quantity / 16, 1) AS tenths, count(*) n FROM lineitem GROUP BY ALL")
def half_even_rounding(spark, sf):
    q = F.col("l_quantity")
    k = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", parse.half_even(q * 0.125, 2).alias("rounded"), parse.half_even(q / 16, 1).alias("tenths"))
    return k.groupBy("l_orderkey", "l_linenumber", "rounded", "tenths").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH f AS (SELECT o_custkey AS entity, o_orderpriority AS label, year(o_orderdate) AS y, CAST(o_orderdate AS DATE) AS filed, o_orderkey AS seq, o_orderstatus AS unit, CAST(round(o_totalprice, 4) AS DECIMAL(18,4)) AS val FROM orders),
  a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, label, y, unit ORDER BY seq) rn FROM f) WHERE rn = 1),
  b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, label, y ORDER BY filed DESC, seq) r2 FROM a) WHERE r2 = 1)
  SELECT entity, label, y, filed, seq, CAST(val AS DOUBLE) val FROM b""")
def fact_dedup(spark, sf):
    """First seen of each unit, then the last filed across units."""
    o = table(spark, sf, "orders")
    f = o.select(
        F.col("o_custkey").alias("entity"), F.col("o_orderpriority").alias("label"), F.year("o_orderdate").cast("long").alias("y"), F.col("o_orderdate").cast("date").alias("filed"),
        F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("unit"), money(F.col("o_totalprice")).cast("double").alias("val"),
    )
    return dedup.first_then_latest(f, ["entity", "label", "y", "unit"], F.col("seq"), ["entity", "label", "y"], F.col("filed")).drop("unit")


_RECON = HOLDINGS + """, a AS (SELECT ticker, period, CAST(sum(fv) AS DOUBLE) held, count(*) n FROM h GROUP BY 1, 2),
  r AS (SELECT n_name AS ticker, CAST(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS period, CAST(sum(CAST(round(l_extendedprice * 0.95, 4) AS DECIMAL(18,4))) AS DOUBLE) * 1000 AS reported
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_linenumber <= 6 GROUP BY 1, 2),
  d AS (SELECT a.ticker, a.period, held, n, reported / 1000 AS reported_k, (held - reported / 1000) * 100 / (reported / 1000) AS delta_pct FROM a LEFT JOIN r ON a.ticker = r.ticker AND a.period = r.period),
  c AS (SELECT *, CASE WHEN delta_pct IS NULL THEN 'missing' WHEN abs(delta_pct) <= 5 THEN 'match' WHEN abs(delta_pct) <= 10 THEN 'near' ELSE 'mismatch' END AS status FROM d) """


def recon(spark, sf):
    """Holdings against a reported figure in dollars: the lines but the seventh, at 95 per cent of price."""
    held = holdings(spark, sf).groupBy("ticker", "period").agg(F.sum("fv").cast("double").alias("held"), F.count(F.lit(1)).alias("n"))
    li = table(spark, sf, "lineitem").filter("l_linenumber <= 6")
    li = li.join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    r = li.groupBy(F.col("n_name").alias("ticker"), F.date_sub(F.add_months(F.trunc("l_shipdate", "quarter"), 3), 1).alias("period"))
    r = r.agg((F.sum(money(F.col("l_extendedprice") * 0.95)).cast("double") * 1000).alias("reported"))
    d = held.join(r, ["ticker", "period"], "left").withColumn("reported_k", F.col("reported") / 1000)
    d = d.withColumn("delta_pct", parse.safe_ratio((F.col("held") - F.col("reported_k")) * 100, F.col("reported_k")))
    return d.withColumn("status", reconcile.band(F.col("delta_pct")))


@query(_RECON + "SELECT ticker, period, held, n, reported_k, round(delta_pct, 4) AS delta_pct, status FROM c")
def reconcile_periods(spark, sf):
    return recon(spark, sf).select("ticker", "period", "held", "n", "reported_k", F.round("delta_pct", 4).alias("delta_pct"), "status")


_TRUST = _RECON + """, t AS (SELECT ticker, count(*) n, count(*) FILTER (WHERE status = 'match') n_match, count(*) FILTER (WHERE status = 'near') n_near, count(*) FILTER (WHERE status = 'mismatch') n_mismatch FROM c GROUP BY 1),
  k AS (SELECT *, n_match * 100.0::DOUBLE / nullif(n_match + n_near + n_mismatch, 0) AS share FROM t),
  g AS (SELECT * EXCLUDE (share), round(share, 4) AS match_pct, CASE WHEN share IS NULL THEN 'unknown' WHEN n_mismatch = 0 AND share >= 80 THEN 'good' WHEN share >= 50 THEN 'warn' ELSE 'bad' END AS trust FROM k) """


@query(_TRUST + "SELECT * FROM g")
def reconcile_trust(spark, sf):
    n = lambda s: F.count_if(F.col("status") == s)
    t = recon(spark, sf).groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), n("match").alias("n_match"), n("near").alias("n_near"), n("mismatch").alias("n_mismatch"))
    m, near, off = F.col("n_match"), F.col("n_near"), F.col("n_mismatch")
    return t.withColumn("match_pct", F.round(parse.safe_ratio(m * 100.0, m + near + off), 4)).withColumn("trust", reconcile.trust(m, near, off))


@query(_TRUST + "SELECT trust, count(*) tickers, sum(n)::BIGINT periods, sum(n_match)::BIGINT n_match FROM g GROUP BY ROLLUP (trust)")
def quality_rollup(spark, sf):
    return reconcile_trust(spark, sf).rollup("trust").agg(F.count(F.lit(1)).alias("tickers"), F.sum("n").alias("periods"), F.sum("n_match").alias("n_match"))


@query("""WITH h AS (SELECT l_returnflag AS k, CAST(date_trunc('month', l_shipdate) AS DATE) AS m, sum(CAST(round(l_extendedprice, 4) AS DECIMAL(18,4))) AS v FROM lineitem GROUP BY 1, 2),
  r AS (SELECT k, m, CAST(v AS DOUBLE) AS held, CAST(v AS DOUBLE) * CASE k WHEN 'A' THEN 1000 WHEN 'N' THEN 1 ELSE 1000000 END * 1.02 AS reported FROM h),
  c AS (SELECT k, s.ord, s.scale, median(held / (reported / s.scale)) AS ratio FROM r, (VALUES (0, 1.0), (1, 1e3), (2, 1e6), (3, 1e-3), (4, 1e-6)) s(ord, scale) GROUP BY 1, 2, 3),
  b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY abs(ln(ratio)), ord) rn FROM c) SELECT k, CAST(scale AS DOUBLE) scale, round(CAST(ratio AS DOUBLE), 6) ratio FROM b WHERE rn = 1""")
def scale_inference(spark, sf):
    h = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("k"), F.trunc("l_shipdate", "month").alias("m")).agg(F.sum(money(F.col("l_extendedprice"))).cast("double").alias("held"))
    unit = F.when(F.col("k") == "A", 1000).when(F.col("k") == "N", 1).otherwise(1_000_000)
    s = reconcile.infer_scale(h.withColumn("reported", F.col("held") * unit * 1.02), ["k"], "held", "reported")
    return s.withColumn("ratio", F.round("ratio", 6))


@query("""WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase'), f AS (SELECT event_id AS filing, user_id, CAST(ts AS DATE) AS filed FROM events WHERE event_type = 'view'),
  c AS (SELECT event_id, d, filing, abs(d - filed) AS gap, row_number() OVER (PARTITION BY event_id ORDER BY abs(d - filed), filing) rn FROM e JOIN f ON e.user_id = f.user_id AND abs(d - filed) <= 7)
  SELECT event_id, d, filing, gap FROM c WHERE rn = 1""")
def nearest_within_7_days(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("d"), "event_type")
    f = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("filing"), F.col("d").alias("filed"))
    p = e.filter("event_type = 'purchase'").drop("event_type")
    near = joins.nearest_within(p, f, ["user_id"], "event_id", "d", "filed", 7, F.col("filing"))
    return near.select("event_id", "d", "filing", F.abs("gap").cast("long").alias("gap"))


@query("""SELECT user_id, d, event_id, event_type FROM (SELECT user_id, CAST(ts AS DATE) AS d, event_id, event_type, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY CASE WHEN event_type = 'error' THEN 1 ELSE 0 END, event_id DESC) rn FROM events) WHERE rn = 1""")
def original_over_amendment(spark, sf):
    """One filing of each user and day: no error if there is another, then the last."""
    e = table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("d"), "event_id", "event_type")
    return dedup.keep_best(e, ["user_id", "d"], (F.col("event_type") == "error").cast("int"), -F.col("event_id"))


@query("""SELECT user_id, event_type, max_by(v, abs(v)) AS largest FROM (SELECT user_id, event_type, CAST(round(value - 250, 4) AS DOUBLE) AS v, event_id FROM events) GROUP BY 1, 2""")
def largest_absolute(spark, sf):
    v = F.round(F.col("value") - 250, 4)
    return table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.max_by(v, F.abs(v)).alias("largest"))


@query("""SELECT CAST(ts AS DATE) AS d, """ + ", ".join(f"CAST(sum(CAST(round(value, 4) AS DECIMAL(18,4))) FILTER (WHERE event_type = '{t}') AS DOUBLE) AS \"{t}\"" for t in ("click", "error", "purchase", "view")) + " FROM events GROUP BY 1")
def overview_pivot(spark, sf):
    e = table(spark, sf, "events").select(F.col("ts").cast("date").alias("d"), "event_type", money(F.col("value")).alias("v"))
    return e.groupBy("d").pivot("event_type", ["click", "error", "purchase", "view"]).agg(F.sum("v").cast("double"))


@query("""SELECT o_orderkey, v AS quarterly, label FROM (SELECT o_orderkey, CASE WHEN days BETWEEN 75 AND 110 THEN p ELSE p * 365 / days / 4 END AS v, CASE WHEN days <= 100 THEN 'Q' WHEN days <= 195 THEN 'H1' WHEN days <= 290 THEN '9M' ELSE 'FY' END AS label
  FROM (SELECT o_orderkey, o_totalprice AS p, 1 + o_custkey % 366 AS days FROM orders))""")
def quarterly_values(spark, sf):
    days = 1 + F.col("o_custkey") % 366
    return table(spark, sf, "orders").select("o_orderkey", parse.quarterly(F.col("o_totalprice"), days).alias("quarterly"), parse.duration_label(days).alias("label"))


@query("""WITH p AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase'), f AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'view') SELECT * FROM p EXCEPT SELECT * FROM f""")
def missing_periods(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("d"), "event_type")
    days = lambda t: e.filter(F.col("event_type") == t).select("user_id", "d").distinct()
    return days("purchase").join(days("view"), ["user_id", "d"], "left_anti")


@query("""WITH m AS (SELECT user_id, CAST(ts AS DATE) AS d, CAST(sum(CAST(round(value, 4) AS DECIMAL(18,4))) AS DOUBLE) v FROM events GROUP BY 1, 2) SELECT user_id, d, v, CAST(sum(CAST(round(v, 4) AS DECIMAL(18,4))) OVER (PARTITION BY user_id ORDER BY d ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS DOUBLE) AS last4 FROM m""")
def trailing_four(spark, sf):
    m = table(spark, sf, "events").groupBy("user_id", F.col("ts").cast("date").alias("d")).agg(F.sum(money(F.col("value"))).alias("v"))
    w = Window.partitionBy("user_id").orderBy("d").rowsBetween(-3, 0)
    return m.select("user_id", "d", F.col("v").cast("double").alias("v"), F.sum("v").over(w).cast("double").alias("last4"))
