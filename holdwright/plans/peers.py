"""Funds among their peers: medians, ranks, percentiles, nearest."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import aggregate as A
from ..operators import rank
from .binding import HOLDINGS, holdings, query

METRICS = ["fv", "cash_rate", "spread", "floating_pct", "young_pct", "top_sector_pct"]
FOCUS = "NATION_7"


def sector_shares(h):
    """A fund's sectors with their percentage of its value, as one division of exact sums."""
    whole = F.sum("s").over(Window.partitionBy("ticker")).cast("double")
    return h.groupBy("ticker", "industry").agg(F.sum("fv").alias("s")).withColumn("pct", F.col("s").cast("double") * 100 / whole)


def peer_rows(spark, sf):
    """A row of metrics for every fund, over its last period."""
    h = A.latest(holdings(spark, sf), ["ticker"], "period")
    fv = F.col("fv")
    total = F.sum(fv).cast("double")
    part = lambda ok: F.round(F.coalesce(F.sum(F.when(ok, fv)), F.lit(0)).cast("double") * 100 / total, 4)
    one = h.groupBy("ticker").agg(
        total.alias("fv"), F.round(A.weighted_avg(F.col("cash_rate"), fv), 6).alias("cash_rate"), F.round(A.weighted_avg(F.col("spread"), fv), 6).alias("spread"),
        part(text.rate_type(text.benchmark(F.col("rate"))) == "Floating").alias("floating_pct"), part(F.datediff("period", "acquired") < 60).alias("young_pct"),
        F.countDistinct(F.year("acquired")).alias("vintages"),
    )
    sectors = sector_shares(h)
    top = A.top_k(sectors, ["ticker"], 3, F.desc("s"), F.asc("industry"))
    top = top.groupBy("ticker").agg(
        F.max("pct").alias("top_sector_pct"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "industry"))), lambda x: x["industry"]), "|").alias("top_sectors")
    )
    return one.join(top, "ticker")


PEERS = HOLDINGS + """, l AS (SELECT h.* FROM h JOIN (SELECT ticker, max(period) AS period FROM h GROUP BY 1) m ON h.ticker = m.ticker AND h.period = m.period),
  o AS (SELECT ticker, CAST(sum(fv) AS DOUBLE) fv, round(sum(CASE WHEN cash_rate > 0 THEN cash_rate * fv END) / sum(CASE WHEN cash_rate > 0 THEN fv END), 6) cash_rate,
    round(sum(CASE WHEN spread > 0 THEN spread * fv END) / sum(CASE WHEN spread > 0 THEN fv END), 6) spread,
    round(CAST(coalesce(sum(CASE WHEN rate IN ('SOFR', 'LIBOR', 'Prime') THEN fv END), 0) AS DOUBLE) * 100 / CAST(sum(fv) AS DOUBLE), 4) floating_pct,
    round(CAST(coalesce(sum(CASE WHEN period - acquired < 60 THEN fv END), 0) AS DOUBLE) * 100 / CAST(sum(fv) AS DOUBLE), 4) young_pct, count(DISTINCT year(acquired)) vintages FROM l GROUP BY 1),
  s AS (SELECT ticker, industry, s, row_number() OVER (PARTITION BY ticker ORDER BY s DESC, industry) rn, CAST(s AS DOUBLE) * 100 / CAST(sum(s) OVER (PARTITION BY ticker) AS DOUBLE) pct FROM (SELECT ticker, industry, sum(fv) s FROM l GROUP BY 1, 2)),
  t AS (SELECT ticker, max(pct) top_sector_pct, string_agg(industry, '|' ORDER BY rn) top_sectors FROM s WHERE rn <= 3 GROUP BY 1),
  p AS (SELECT o.*, top_sector_pct, top_sectors FROM o JOIN t ON o.ticker = t.ticker),
  u AS (""" + " UNION ALL ".join(f"SELECT ticker, '{m}' AS metric, CAST({m} AS DOUBLE) AS v FROM p" for m in METRICS) + ") "


@query(PEERS + "SELECT * FROM p")
def peer_table(spark, sf):
    return peer_rows(spark, sf)


@query(PEERS + "SELECT metric, round(median(v), 6) AS median FROM u WHERE v IS NOT NULL GROUP BY 1")
def peer_medians(spark, sf):
    return rank.long_metrics(peer_rows(spark, sf), ["ticker"], METRICS).groupBy("metric").agg(F.round(F.median("value"), 6).alias("median"))


@query(PEERS + "SELECT industry AS sector, round(median(pct), 6) AS median, count(*) n FROM s GROUP BY 1 HAVING count(*) >= 3")
def sector_medians(spark, sf):
    s = sector_shares(A.latest(holdings(spark, sf), ["ticker"], "period"))
    return s.groupBy(F.col("industry").alias("sector")).agg(F.round(F.median("pct"), 6).alias("median"), F.count(F.lit(1)).alias("n")).filter("n >= 3")


@query(PEERS + f"""SELECT s.industry AS sector, s.pct, m.median, round(s.pct - m.median, 6) AS tilt FROM s JOIN (SELECT industry, round(median(pct), 6) AS median FROM s GROUP BY 1 HAVING count(*) >= 3) m ON s.industry = m.industry WHERE ticker = '{FOCUS}'""")
def sector_tilt(spark, sf):
    s = sector_shares(A.latest(holdings(spark, sf), ["ticker"], "period"))
    return s.filter(F.col("ticker") == FOCUS).select(F.col("industry").alias("sector"), "pct").join(sector_medians(spark, sf).drop("n"), "sector").withColumn("tilt", F.round(F.col("pct") - F.col("median"), 6))


@query(PEERS + "SELECT ticker, metric, v AS \"value\", rank() OVER (PARTITION BY metric ORDER BY v DESC) AS rank FROM u WHERE v IS NOT NULL")
def competition_rank(spark, sf):
    r = rank.competition_rank(rank.long_metrics(peer_rows(spark, sf), ["ticker"], METRICS), ["metric"], F.desc("value"))
    return r.withColumn("rank", F.col("rank").cast("long"))


@query(PEERS + "SELECT ticker, metric, CASE WHEN count(*) OVER (PARTITION BY metric) < 2 THEN 50 ELSE round(100 * percent_rank() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'top_sector_pct' THEN -v ELSE v END)) END AS score FROM u WHERE v IS NOT NULL")
def percentile_scorecard(spark, sf):
    v = rank.long_metrics(peer_rows(spark, sf), ["ticker"], METRICS)
    worst_first = F.when(F.col("metric") == "top_sector_pct", -F.col("value")).otherwise(F.col("value"))
    return rank.percentile_score(v, ["metric"], worst_first).select("ticker", "metric", "score")


@query(PEERS + "SELECT ticker, metric, round((v - min(v) OVER w) / nullif(max(v) OVER w - min(v) OVER w, 0), 6) AS scaled FROM u WHERE v IS NOT NULL WINDOW w AS (PARTITION BY metric)")
def heat_cells(spark, sf):
    v = rank.min_max(rank.long_metrics(peer_rows(spark, sf), ["ticker"], METRICS), ["metric"], "value")
    return v.select("ticker", "metric", F.round("scaled", 6).alias("scaled"))


@query(PEERS + f""", r AS (SELECT max(fv) - min(fv) rf, max(cash_rate) - min(cash_rate) rc FROM p), f AS (SELECT fv ff, cash_rate fc FROM p WHERE ticker = '{FOCUS}')
  SELECT ticker, sqrt((fv - ff) / rf * ((fv - ff) / rf) + (cash_rate - fc) / rc * ((cash_rate - fc) / rc)) AS distance FROM p, r, f WHERE ticker <> '{FOCUS}' ORDER BY distance, ticker LIMIT 6""")
def nearest_peers(spark, sf):
    return rank.nearest(peer_rows(spark, sf).select("ticker", "fv", "cash_rate"), "ticker", FOCUS, ["fv", "cash_rate"], 6).select("ticker", "distance")


@query(PEERS + f", r AS (SELECT ticker, fv, rank() OVER (ORDER BY fv DESC) AS rank, row_number() OVER (ORDER BY fv DESC, ticker) rn FROM p) SELECT ticker, fv, rank FROM r WHERE rn <= 5 OR ticker = '{FOCUS}'")
def leaderboard_top5(spark, sf):
    return rank.leaderboard(peer_rows(spark, sf).select("ticker", "fv"), "ticker", F.col("fv"), FOCUS)


@query(PEERS + "SELECT ticker, fv, CASE WHEN fv >= 1500000 THEN 'large' WHEN fv >= 1000000 THEN 'medium' ELSE 'small' END AS cohort FROM p")
def cohorts(spark, sf):
    size = F.when(F.col("fv") >= 1_500_000, "large").when(F.col("fv") >= 1_000_000, "medium").otherwise("small")
    return peer_rows(spark, sf).select("ticker", "fv", size.alias("cohort"))
