"""Changes between periods, and flags over a fund's history."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import joins, order
from .binding import HOLDINGS, holdings, query

TICKER = "NATION_3"


def company_values(spark, sf):
    return holdings(spark, sf).groupBy("ticker", "period", "company").agg(F.sum("fv").alias("fv"), F.count(F.lit(1)).alias("n"))


def period_pairs(values):
    """(ticker, prev_period, period): each period of a fund after the one before it."""
    periods = values.select("ticker", "period").distinct()
    return order.previous(periods, ["ticker"], "period", ["period"]).filter("prev_period is not null")


def changes(values, value="fv", keys=("company",)):
    """One row per fund, pair of consecutive periods and company, by full outer join. Each side joins the
    short list of period pairs first, so both sides of the outer join have one key."""
    pairs = period_pairs(values)
    before = values.join(pairs.select("ticker", F.col("prev_period").alias("period"), F.col("period").alias("at")), ["ticker", "period"])
    after = values.join(pairs.select("ticker", "period"), ["ticker", "period"]).withColumn("at", F.col("period"))
    return joins.difference(before, after, ["ticker", "at", *keys], value).withColumnRenamed("at", "period")


_PAIRS = HOLDINGS + """, v AS (SELECT ticker, period, company, sum(fv) fv, count(*) n FROM h GROUP BY 1, 2, 3),
  p AS (SELECT * FROM (SELECT ticker, period, lag(period) OVER (PARTITION BY ticker ORDER BY period) AS prev FROM (SELECT DISTINCT ticker, period FROM v)) WHERE prev IS NOT NULL),
  b AS (SELECT p.ticker, p.period, company, fv, n FROM v JOIN p ON v.ticker = p.ticker AND v.period = p.prev),
  a AS (SELECT p.ticker, p.period, company, fv, n FROM v JOIN p ON v.ticker = p.ticker AND v.period = p.period),
  d AS (SELECT ticker, period, company, b.fv AS before_fv, a.fv AS after_fv, coalesce(a.fv, 0) - coalesce(b.fv, 0) AS delta,
    CASE WHEN b.fv IS NULL THEN 'Added' WHEN a.fv IS NULL THEN 'Removed' WHEN a.fv > b.fv THEN 'Increased' WHEN a.fv < b.fv THEN 'Decreased' ELSE 'Unchanged' END AS status
    FROM b FULL OUTER JOIN a USING (ticker, period, company)) """


def _double(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@query(_PAIRS + "SELECT ticker, period, company, CAST(before_fv AS DOUBLE) AS \"before\", CAST(after_fv AS DOUBLE) AS \"after\", CAST(delta AS DOUBLE) delta, status FROM d")
def period_diff(spark, sf):
    return _double(changes(company_values(spark, sf)), "before", "after", "delta").select("ticker", "period", "company", "before", "after", "delta", "status")


@query(_PAIRS + """SELECT ticker, period, count(*) FILTER (WHERE status = 'Added') n_new, count(*) FILTER (WHERE status = 'Removed') n_exited,
  CAST(coalesce(sum(delta) FILTER (WHERE status = 'Added'), 0) AS DOUBLE) new_fv, CAST(coalesce(sum(-delta) FILTER (WHERE status = 'Removed'), 0) AS DOUBLE) exited_fv, CAST(sum(delta) AS DOUBLE) net FROM d GROUP BY 1, 2""")
def diff_summary(spark, sf):
    d = changes(company_values(spark, sf))
    s = lambda st, c: F.coalesce(F.sum(F.when(F.col("status") == st, c)), F.lit(0)).cast("double")
    return d.groupBy("ticker", "period").agg(
        F.count_if(F.col("status") == "Added").alias("n_new"), F.count_if(F.col("status") == "Removed").alias("n_exited"),
        s("Added", F.col("delta")).alias("new_fv"), s("Removed", -F.col("delta")).alias("exited_fv"), F.sum("delta").cast("double").alias("net"),
    )


@query(_PAIRS + """SELECT ticker, period, company, CAST(delta AS DOUBLE) delta, side, rn FROM (
  SELECT *, CASE WHEN delta > 0 THEN 'up' ELSE 'down' END AS side, row_number() OVER (PARTITION BY ticker, period, delta > 0 ORDER BY abs(delta) DESC, company) rn FROM d WHERE delta <> 0) WHERE rn <= 15""")
def largest_changes(spark, sf):
    d = changes(company_values(spark, sf)).filter("delta <> 0").withColumn("side", F.when(F.col("delta") > 0, "up").otherwise("down"))
    return _double(A.top_k(d, ["ticker", "period", "side"], 15, F.desc(F.abs("delta")), F.asc("company")), "delta").select("ticker", "period", "company", "delta", "side", "rn")


@query(_PAIRS + f"SELECT period, company, CAST(delta AS DOUBLE) delta, status FROM d WHERE ticker = '{TICKER}' AND status IN ('Increased', 'Decreased') AND abs(delta) >= 5000 AND contains(lower(company), '00000')")
def diff_filtered(spark, sf):
    values = company_values(spark, sf).filter(F.col("ticker") == TICKER)
    d = changes(values).filter(F.col("status").isin("Increased", "Decreased") & (F.abs("delta") >= 5000) & F.lower("company").contains("00000"))
    return _double(d, "delta").select("period", "company", "delta", "status")


@query(_PAIRS + """SELECT ticker, period, count(*) FILTER (WHERE status = 'Added') added, count(*) FILTER (WHERE status = 'Removed') removed,
  count(*) FILTER (WHERE status IN ('Increased', 'Decreased')) modified, count(*) FILTER (WHERE status = 'Unchanged') unchanged,
  abs(CAST(sum(delta) AS DOUBLE)) > 0.35 * CAST(coalesce(sum(before_fv), 0) AS DOUBLE) AS large_move FROM d GROUP BY 1, 2""")
def large_moves(spark, sf):
    d = changes(company_values(spark, sf))
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    return d.groupBy("ticker", "period").agg(
        n("Added").alias("added"), n("Removed").alias("removed"), n("Increased", "Decreased").alias("modified"), n("Unchanged").alias("unchanged"),
        (F.abs(F.sum("delta").cast("double")) > 0.35 * F.coalesce(F.sum("before"), F.lit(0)).cast("double")).alias("large_move"),
    )


@query(HOLDINGS + """, v AS (SELECT ticker, period, company, sum(fv) fv, count(*) n, min(kind) k0, max(kind) k1, count(DISTINCT industry) i, min(matures) m0, max(matures) m1 FROM h WHERE year(period) IN (1996, 1997) AND month(period) = 12 GROUP BY 1, 2, 3),
  b AS (SELECT * FROM v WHERE year(period) = 1996), a AS (SELECT * FROM v WHERE year(period) = 1997)
  SELECT ticker, company, CAST(b.fv AS DOUBLE) fv_before, CAST(a.fv AS DOUBLE) fv_after, b.n n_before, a.n n_after,
    concat_ws(',', CASE WHEN b.fv IS DISTINCT FROM a.fv THEN 'fv' END, CASE WHEN b.n IS DISTINCT FROM a.n THEN 'n' END, CASE WHEN b.k0 IS DISTINCT FROM a.k0 OR b.k1 IS DISTINCT FROM a.k1 THEN 'kind' END,
      CASE WHEN b.i IS DISTINCT FROM a.i THEN 'industries' END, CASE WHEN b.m0 IS DISTINCT FROM a.m0 OR b.m1 IS DISTINCT FROM a.m1 THEN 'matures' END) AS changed
  FROM b FULL OUTER JOIN a USING (ticker, company)""")
def company_diff_fields(spark, sf):
    """Any two periods: which of a company's fields differ."""
    h = holdings(spark, sf).filter("month(period) = 12 and year(period) in (1996, 1997)")
    v = h.groupBy("ticker", "period", "company").agg(
        F.sum("fv").alias("fv"), F.count(F.lit(1)).alias("n"), F.struct(F.min("kind"), F.max("kind")).alias("kind"),
        F.countDistinct("industry").alias("industries"), F.struct(F.min("matures"), F.max("matures")).alias("matures"),
    )
    fields = ["fv", "n", "kind", "industries", "matures"]
    side = lambda y, s: v.filter(F.year("period") == y).select("ticker", "company", *[F.col(c).alias(f"{c}_{s}") for c in fields])
    d = side(1996, "before").join(side(1997, "after"), ["ticker", "company"], "full_outer")
    changed = F.concat_ws(",", *[F.when(~F.col(f"{c}_before").eqNullSafe(F.col(f"{c}_after")), c) for c in fields])
    return _double(d, "fv_before", "fv_after").select("ticker", "company", "fv_before", "fv_after", "n_before", "n_after", changed.alias("changed"))


@query(HOLDINGS + """, t AS (SELECT ticker, period, CAST(sum(fv) AS DOUBLE) fv FROM h GROUP BY 1, 2),
  w AS (SELECT *, list_sort(list_filter(list(fv) OVER (PARTITION BY ticker ORDER BY period ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), lambda x: x <> 0)) AS l FROM t),
  m AS (SELECT ticker, period, fv, (l[(len(l) + 1) // 2] + l[len(l) // 2 + 1]) / 2 AS med FROM w)
  SELECT ticker, period, fv, med AS trailing_median, CASE WHEN fv > 1.35 * med THEN 'high' WHEN fv < 0.7 * med THEN 'low' END AS flag FROM m""")
def trailing_median_flags(spark, sf):
    t = holdings(spark, sf).groupBy("ticker", "period").agg(F.sum("fv").cast("double").alias("fv"))
    m = order.trailing_median(t, ["ticker"], "period", "fv")
    flag = F.when(F.col("fv") > 1.35 * F.col("trailing_median"), "high").when(F.col("fv") < 0.7 * F.col("trailing_median"), "low")
    return m.withColumn("flag", flag)


@query(HOLDINGS + """, t AS (SELECT ticker, period, count(*) n FROM h GROUP BY 1, 2), w AS (SELECT *, lag(n) OVER (PARTITION BY ticker ORDER BY period) prev_n FROM t)
  SELECT ticker, period, n, prev_n, coalesce(n < 0.65 * prev_n, false) AS dropped FROM w""")
def row_drop_flags(spark, sf):
    t = holdings(spark, sf).groupBy("ticker", "period").agg(F.count(F.lit(1)).alias("n"))
    return order.previous(t, ["ticker"], "period", ["n"]).withColumn("dropped", F.coalesce(F.col("n") < 0.65 * F.col("prev_n"), F.lit(False)))


@query(HOLDINGS + """, l AS (SELECT ticker, max(period) AS period FROM h GROUP BY 1) SELECT h.ticker, h.period, company, kind, CAST(fv AS DOUBLE) fv FROM h JOIN l ON h.ticker = l.ticker AND h.period = l.period""")
def latest_positions(spark, sf):
    h = A.latest(holdings(spark, sf), ["ticker"], "period")
    return h.select("ticker", "period", "company", "kind", F.col("fv").cast("double").alias("fv"))


@query(HOLDINGS + "SELECT ticker, period, lag(period) OVER (PARTITION BY ticker ORDER BY period) AS prev_period FROM (SELECT DISTINCT ticker, period FROM h)")
def consecutive_periods(spark, sf):
    return order.previous(holdings(spark, sf).select("ticker", "period").distinct(), ["ticker"], "period", ["period"])


@query(HOLDINGS + """, v AS (SELECT ticker, company, sum(fv) fv FROM h GROUP BY 1, 2) SELECT ticker, company, round(CAST(fv AS DOUBLE) * 100 / CAST(sum(fv) OVER (PARTITION BY ticker) AS DOUBLE), 6) AS pct FROM v""")
def percent_of_portfolio(spark, sf):
    v = holdings(spark, sf).groupBy("ticker", "company").agg(F.sum("fv").alias("fv"))
    total = F.sum("fv").over(Window.partitionBy("ticker")).cast("double")
    return v.select("ticker", "company", F.round(F.col("fv").cast("double") * 100 / total, 6).alias("pct"))


@query(HOLDINGS + """, r AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY period DESC) rn FROM (SELECT ticker, period, CAST(sum(fv) AS DOUBLE) fv FROM h GROUP BY 1, 2)) SELECT ticker, period, fv, rn FROM r WHERE rn <= 12""")
def recent_history(spark, sf):
    t = holdings(spark, sf).groupBy("ticker", "period").agg(F.sum("fv").cast("double").alias("fv"))
    return A.top_k(t, ["ticker"], 12, F.desc("period"))
