"""Period analytics: totals, rates, breakdowns, coverage, top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text, vocab
from ..operators import aggregate as A
from .binding import HOLDINGS, holdings, query

KEYS = ["ticker", "period"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
WALL = (1999, 2006)
WALL_LABELS = [f"≤{WALL[0]}", *(str(y) for y in range(WALL[0] + 1, WALL[1])), f"{WALL[1]}+"]


def common():
    return {"fv": F.sum("fv").cast("double"), "n": F.count(F.lit(1))}


def pct(c="pct"):
    return F.round(F.col(c).cast("double"), 4).alias(c)


@query(HOLDINGS + "SELECT ticker, period, CAST(sum(fv) AS DOUBLE) fv, CAST(sum(principal) AS DOUBLE) principal, CAST(sum(cost) AS DOUBLE) AS \"cost\", count(*) n, count(DISTINCT company) companies FROM h GROUP BY 1, 2")
def period_totals(spark, sf):
    sums = [F.sum(c).cast("double").alias(c) for c in ("fv", "principal", "cost")]
    return holdings(spark, sf).groupBy(*KEYS).agg(*sums, F.count(F.lit(1)).alias("n"), F.countDistinct("company").alias("companies"))


@query(HOLDINGS + """SELECT ticker, period,
  round(sum(CASE WHEN cash_rate > 0 THEN cash_rate * fv END) / sum(CASE WHEN cash_rate > 0 THEN fv END), 6) AS cash_rate,
  round(sum(CASE WHEN spread > 0 THEN spread * fv END) / sum(CASE WHEN spread > 0 THEN fv END), 6) AS spread FROM h GROUP BY 1, 2""")
def weighted_rates(spark, sf):
    return holdings(spark, sf).groupBy(*KEYS).agg(*[F.round(A.weighted_avg(F.col(c), F.col("fv")), 6).alias(c) for c in ("cash_rate", "spread")])


@query(HOLDINGS + """SELECT ticker, period, kind, CAST(fv AS DOUBLE) fv, n, CAST(gain AS DOUBLE) gain, round(CAST(gain AS DOUBLE) * 100 / CAST(cost AS DOUBLE), 4) AS gain_pct,
  round(CAST(fv AS DOUBLE) * 100 / CAST(sum(fv) OVER (PARTITION BY ticker, period) AS DOUBLE), 4) AS pct
  FROM (SELECT ticker, period, kind, sum(fv) fv, count(*) n, sum(fv - cost) gain, sum(cost) AS "cost" FROM h GROUP BY 1, 2, 3)""")
def type_mix(spark, sf):
    m = common() | {"gain": F.sum(F.col("fv") - F.col("cost")).cast("double"), "c": F.sum("cost").cast("double")}
    b = A.breakdown(holdings(spark, sf), KEYS, "kind", m, "fv")
    return b.select(*KEYS, "kind", "fv", "n", "gain", F.round(F.col("gain") * 100 / F.col("c"), 4).alias("gain_pct"), pct())


@query(HOLDINGS + """, b AS (SELECT ticker, brand, sum(fv) fv FROM h GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY CAST(fv AS DOUBLE) DESC, brand) rn, count(*) OVER (PARTITION BY ticker) k FROM b)
  SELECT ticker, CASE WHEN k > 13 AND rn > 12 THEN 'Other' ELSE brand END AS sector, CAST(sum(fv) AS DOUBLE) fv FROM r GROUP BY 1, 2""")
def sector_top12_other(spark, sf):
    b = holdings(spark, sf).groupBy("ticker", F.col("brand").alias("sector")).agg(F.sum("fv").alias("fv"))
    return A.top_k_and_other(b, ["ticker"], "sector", ["fv"], 12, 13).withColumn("fv", F.col("fv").cast("double"))


@query(HOLDINGS + "SELECT ticker, period, year(acquired) AS vintage, CAST(sum(fv) AS DOUBLE) fv, count(*) n, round(CAST(sum(fv) AS DOUBLE) * 100 / CAST(sum(cost) AS DOUBLE), 4) AS mark FROM h GROUP BY 1, 2, 3")
def vintage_marks(spark, sf):
    g = holdings(spark, sf).groupBy(*KEYS, F.year("acquired").cast("long").alias("vintage")).agg(F.sum("fv").cast("double").alias("fv"), F.count(F.lit(1)).alias("n"), F.sum("cost").cast("double").alias("c"))
    return g.select(*KEYS, "vintage", "fv", "n", F.round(F.col("fv") * 100 / F.col("c"), 4).alias("mark"))


def _case(expr, cuts, labels):
    return "CASE " + " ".join(f"WHEN {expr} < {c} THEN '{x}'" for c, x in zip(cuts, labels, strict=False)) + f" ELSE '{labels[-1]}' END"


_AGE = _case("(period - acquired) / 365.25", [1, 2, 3, 4, 5], vocab.AGE_BUCKETS)
_SPREAD = _case("spread", [3, 4, 5, 6, 7], vocab.SPREAD_BUCKETS)


def _labels(values):
    return "(VALUES " + ", ".join(f"('{v}')" for v in values) + ") v(bucket)"


@query(HOLDINGS + f""", b AS (SELECT ticker, period, {_AGE} AS bucket, CAST(sum(fv) AS DOUBLE) fv, count(*) n FROM h GROUP BY 1, 2, 3)
  SELECT k.ticker, k.period, v.bucket, coalesce(b.fv, 0) fv, coalesce(b.n, 0) n FROM (SELECT DISTINCT ticker, period FROM h) k CROSS JOIN {_labels(vocab.AGE_BUCKETS)}
  LEFT JOIN b ON b.ticker = k.ticker AND b.period = k.period AND b.bucket = v.bucket""")
def age_buckets(spark, sf):
    age = F.datediff("period", "acquired") / 365.25
    b = holdings(spark, sf).groupBy(*KEYS, text.age_bucket(age).alias("bucket")).agg(*[c.alias(n) for n, c in common().items()])
    return A.zero_filled(b, KEYS, "bucket", vocab.AGE_BUCKETS, ["fv", "n"])


@query(HOLDINGS + """SELECT ticker, CASE WHEN matures <= 2000 THEN CAST(matures AS VARCHAR) WHEN matures <= 2002 THEN '2001–2002' WHEN matures > 2012 THEN CAST(matures AS VARCHAR) ELSE '2003+' END AS bucket,
  CAST(sum(fv) AS DOUBLE) fv, count(*) n FROM h GROUP BY 1, 2""")
def maturity_buckets(spark, sf):
    return holdings(spark, sf).groupBy("ticker", text.maturity_bucket(F.col("matures"), 2000).alias("bucket")).agg(*[c.alias(n) for n, c in common().items()])


@query(HOLDINGS + f""", b AS (SELECT ticker, period, CASE WHEN matures <= {WALL[0]} THEN '≤{WALL[0]}' WHEN matures >= {WALL[1]} THEN '{WALL[1]}+' ELSE CAST(matures AS VARCHAR) END AS bucket,
    CAST(sum(fv) AS DOUBLE) fv, count(*) n, round(sum(CASE WHEN cash_rate > 0 THEN cash_rate * fv END) / sum(CASE WHEN cash_rate > 0 THEN fv END), 6) AS cash_rate,
    round(CAST(coalesce(sum(CASE WHEN rate IN ('SOFR', 'LIBOR', 'Prime') THEN fv END), 0) AS DOUBLE) * 100 / CAST(sum(fv) AS DOUBLE), 4) AS floating_pct FROM h GROUP BY 1, 2, 3)
  SELECT k.ticker, k.period, v.bucket, coalesce(b.fv, 0) fv, coalesce(b.n, 0) n, b.cash_rate, coalesce(b.floating_pct, 0) floating_pct FROM (SELECT DISTINCT ticker, period FROM h) k
  CROSS JOIN {_labels(WALL_LABELS)} LEFT JOIN b ON b.ticker = k.ticker AND b.period = k.period AND b.bucket = v.bucket""")
def maturity_wall(spark, sf):
    h = holdings(spark, sf)
    floating = F.sum(F.when(text.rate_type(text.benchmark(F.col("rate"))) == "Floating", F.col("fv"))).cast("double")
    m = common() | {"cash_rate": F.round(A.weighted_avg(F.col("cash_rate"), F.col("fv")), 6), "floating_pct": F.round(F.coalesce(floating, F.lit(0.0)) * 100 / F.sum("fv").cast("double"), 4)}
    b = h.groupBy(*KEYS, text.wall_bucket(F.col("matures"), *WALL).alias("bucket")).agg(*[c.alias(n) for n, c in m.items()])
    return A.zero_filled(b, KEYS, "bucket", WALL_LABELS, ["fv", "n", "floating_pct"])


@query(HOLDINGS + """SELECT ticker, rate, CAST(fv AS DOUBLE) fv, n, round(CAST(fv AS DOUBLE) * 100 / CAST(sum(fv) OVER (PARTITION BY ticker) AS DOUBLE), 4) AS pct
  FROM (SELECT ticker, coalesce(rate, 'Not Reported') AS rate, sum(fv) fv, count(*) n FROM h GROUP BY 1, 2)""")
def rate_mix(spark, sf):
    h = holdings(spark, sf).withColumn("rate", F.coalesce(text.benchmark(F.col("rate")), F.lit("Not Reported")))
    return A.breakdown(h, ["ticker"], "rate", common(), "fv").withColumn("pct", pct())


@query(HOLDINGS + """SELECT ticker, CASE WHEN rate IS NULL THEN 'Not Reported' WHEN rate = 'Fixed' THEN 'Fixed' ELSE 'Floating' END AS rate_type, CAST(sum(fv) AS DOUBLE) fv, count(*) n FROM h GROUP BY 1, 2""")
def rate_type_mix(spark, sf):
    return holdings(spark, sf).groupBy("ticker", text.rate_type(text.benchmark(F.col("rate"))).alias("rate_type")).agg(*[c.alias(n) for n, c in common().items()])


@query(HOLDINGS + f""", b AS (SELECT ticker, {_SPREAD} AS bucket, CAST(sum(fv) AS DOUBLE) fv, count(*) n FROM h WHERE spread > 0 GROUP BY 1, 2)
  SELECT k.ticker, v.bucket, coalesce(b.fv, 0) fv, coalesce(b.n, 0) n FROM (SELECT DISTINCT ticker FROM h WHERE spread > 0) k CROSS JOIN {_labels(vocab.SPREAD_BUCKETS)}
  LEFT JOIN b ON b.ticker = k.ticker AND b.bucket = v.bucket""")
def spread_histogram(spark, sf):
    b = holdings(spark, sf).filter("spread > 0").groupBy("ticker", text.spread_bucket(F.col("spread")).alias("bucket")).agg(*[c.alias(n) for n, c in common().items()])
    return A.zero_filled(b, ["ticker"], "bucket", vocab.SPREAD_BUCKETS, ["fv", "n"])


@query(HOLDINGS + """SELECT ticker, period, round(CAST(coalesce(sum(CASE WHEN cash_rate > 0 THEN fv END), 0) AS DOUBLE) * 100 / CAST(sum(fv) AS DOUBLE), 4) AS cash_rate,
  round(CAST(coalesce(sum(CASE WHEN spread > 0 THEN fv END), 0) AS DOUBLE) * 100 / CAST(sum(fv) AS DOUBLE), 4) AS spread,
  round(CAST(coalesce(sum(CASE WHEN rate IS NOT NULL THEN fv END), 0) AS DOUBLE) * 100 / CAST(sum(fv) AS DOUBLE), 4) AS rate FROM h GROUP BY 1, 2""")
def coverage_pct(spark, sf):
    h = holdings(spark, sf)
    c = A.coverage(h, KEYS, F.col("fv").cast("double"), {"cash_rate": F.col("cash_rate") > 0, "spread": F.col("spread") > 0, "rate": F.col("rate").isNotNull()})
    return c.select(*KEYS, *[F.round(x, 4).alias(x) for x in ("cash_rate", "spread", "rate")])


_COMPANY = HOLDINGS + ", b AS (SELECT ticker, company, sum(fv) fv, sum(fv - cost) gain FROM h GROUP BY 1, 2)"


@query(_COMPANY + """ SELECT ticker, company, CAST(fv AS DOUBLE) fv, rn FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY fv DESC, company) rn FROM b) WHERE rn <= 10""")
def top10_companies(spark, sf):
    b = holdings(spark, sf).groupBy("ticker", "company").agg(F.sum("fv").alias("fv"))
    return A.top_k(b, ["ticker"], 10, F.desc("fv"), F.asc("company")).withColumn("fv", F.col("fv").cast("double"))


@query(_COMPANY + """, r AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY gain DESC, company) up, row_number() OVER (PARTITION BY ticker ORDER BY gain, company) down FROM b)
  SELECT ticker, company, CAST(gain AS DOUBLE) gain, 'gainer' AS side, up AS rn FROM r WHERE up <= 5 UNION ALL SELECT ticker, company, CAST(gain AS DOUBLE), 'loser', down FROM r WHERE down <= 5""")
def gainers_losers(spark, sf):
    b = holdings(spark, sf).groupBy("ticker", "company").agg(F.sum(F.col("fv") - F.col("cost")).alias("gain"))
    up = A.top_k(b, ["ticker"], 5, F.desc("gain"), F.asc("company")).withColumn("side", F.lit("gainer"))
    down = A.top_k(b, ["ticker"], 5, F.asc("gain"), F.asc("company")).withColumn("side", F.lit("loser"))
    return up.unionByName(down).select("ticker", "company", F.col("gain").cast("double").alias("gain"), "side", "rn")


@query(_COMPANY + """, t AS (SELECT ticker, sum(fv) t FROM b GROUP BY 1), r AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY fv DESC, company) rn FROM b)
  SELECT r.ticker, round(CAST(sum(fv) AS DOUBLE) * 100 / CAST(max(t) AS DOUBLE), 4) AS top10_pct FROM r JOIN t ON r.ticker = t.ticker WHERE rn <= 10 GROUP BY 1""")
def top10_share(spark, sf):
    b = holdings(spark, sf).groupBy("ticker", "company").agg(F.sum("fv").alias("fv"))
    r = A.ranked(b, ["ticker"], F.desc("fv"), F.asc("company")).groupBy("ticker")
    return r.agg(F.round(F.sum(F.when(F.col("rn") <= 10, F.col("fv"))).cast("double") * 100 / F.sum("fv").cast("double"), 4).alias("top10_pct"))


@query(HOLDINGS + """, p AS (SELECT ticker, period, kind, CAST(sum(fv) AS DOUBLE) fv FROM h GROUP BY 1, 2, 3)
  SELECT ticker, period, """ + ", ".join(f"sum(CASE WHEN kind = '{k}' THEN fv END) AS \"{k}\"" for k in TYPES) + " FROM p GROUP BY 1, 2")
def mix_over_time(spark, sf):
    return holdings(spark, sf).groupBy(*KEYS).pivot("kind", TYPES).agg(F.sum("fv").cast("double"))


@query(HOLDINGS + """SELECT ticker, year(acquired) AS vintage, """ + ", ".join(f"round(CAST(sum(CASE WHEN year(period) = {y} THEN fv END) AS DOUBLE) * 100 / CAST(sum(CASE WHEN year(period) = {y} THEN cost END) AS DOUBLE), 4) AS y{y}" for y in range(1996, 2001)) + " FROM h GROUP BY 1, 2")
def vintage_migration(spark, sf):
    when = lambda y, c: F.sum(F.when(F.year("period") == y, F.col(c))).cast("double")
    return holdings(spark, sf).groupBy("ticker", F.year("acquired").cast("long").alias("vintage")).agg(*[F.round(when(y, "fv") * 100 / when(y, "cost"), 4).alias(f"y{y}") for y in range(1996, 2001)])


#: Drill-downs: a kind and a value select positions.
SLICES = {
    "type": lambda v: F.col("kind") == v,
    "sector": lambda v: F.col("industry") == v,
    "rate": lambda v: F.coalesce(text.benchmark(F.col("rate")), F.lit("Not Reported")) == v,
    "rate type": lambda v: text.rate_type(text.benchmark(F.col("rate"))) == v,
    "spread": lambda v: text.spread_bucket(F.when(F.col("spread") > 0, F.col("spread"))) == v,
    "vintage": lambda v: F.year("acquired") == int(v),
    "age": lambda v: text.age_bucket(F.datediff("period", "acquired") / 365.25) == v,
    "maturity": lambda v: text.wall_bucket(F.col("matures"), *WALL) == v,
    "company": lambda v: text.name_key(F.col("company")) == v,
    "no cash rate": lambda v: (F.col("cash_rate") == 0) == (v == "yes"),
}
_PICKS = [("type", "PROMO", "kind = 'PROMO'"), ("sector", "BUILDING", "industry = 'BUILDING'"), ("rate", "SOFR", "rate = 'SOFR'"), ("rate type", "Fixed", "rate = 'Fixed'"),
          ("spread", "5–6%", f"spread > 0 AND {_SPREAD} = '5–6%'"), ("vintage", "1997", "year(acquired) = 1997"), ("age", "0–1 yrs", f"{_AGE} = '0–1 yrs'"),
          ("maturity", "2001", "matures = 2001"), ("company", "customer 000000007", "company = 'Customer#000000007'"), ("no cash rate", "yes", "cash_rate = 0")]


@query(HOLDINGS + ", t AS (SELECT CAST(sum(fv) AS DOUBLE) t FROM h) " + " UNION ALL ".join(
    f"SELECT '{k}' AS slice, '{v}' AS \"value\", count(*) n, CAST(coalesce(sum(fv), 0) AS DOUBLE) fv, round(CAST(coalesce(sum(fv), 0) AS DOUBLE) * 100 / (SELECT t FROM t), 4) AS pct, round(sum(CASE WHEN cash_rate > 0 THEN cash_rate * fv END) / sum(CASE WHEN cash_rate > 0 THEN fv END), 6) AS cash_rate FROM h WHERE {w}" for k, v, w in _PICKS))
def slice_by_kind(spark, sf):
    """All slices in one pass: each is a conditional sum, and the one row of sums is turned into a row a slice."""
    h = holdings(spark, sf)
    fv, zero = F.col("fv"), F.lit(0).cast("decimal(18,4)")
    sums = [F.sum("fv").alias("all")]
    for k, (kind, value, _) in enumerate(_PICKS):
        ok = F.coalesce(SLICES[kind](value), F.lit(False))
        paid = ok & (F.col("cash_rate") > 0)
        sums += [F.count_if(ok).alias(f"n{k}"), F.sum(F.when(ok, fv).otherwise(zero)).alias(f"fv{k}")]
        sums += [F.try_divide(F.sum(F.when(paid, F.col("cash_rate") * fv)), F.sum(F.when(paid, fv))).alias(f"rate{k}")]
    one = h.agg(*sums)
    rows = [F.struct(F.lit(kind).alias("slice"), F.lit(value).alias("value"), F.col(f"n{k}").alias("n"), F.col(f"fv{k}").cast("double").alias("fv"), F.col(f"rate{k}").alias("cash_rate")) for k, (kind, value, _) in enumerate(_PICKS)]
    each = one.select(F.col("all").cast("double").alias("all"), F.explode(F.array(*rows)).alias("r")).select("all", "r.*")
    return each.select("slice", "value", "n", F.coalesce("fv", F.lit(0.0)).alias("fv"), F.round(F.coalesce("fv", F.lit(0.0)) * 100 / F.col("all"), 4).alias("pct"), F.round("cash_rate", 6).alias("cash_rate"))


@query(HOLDINGS + "SELECT ticker, kind, CAST(sum(fv) AS DOUBLE) / count(*) AS avg_fv FROM h GROUP BY 1, 2")
def average_position(spark, sf):
    return holdings(spark, sf).groupBy("ticker", "kind").agg((F.sum("fv").cast("double") / F.count(F.lit(1))).alias("avg_fv"))


@query(HOLDINGS + "SELECT ticker, period, count(*) n, round(count(*) FILTER (WHERE rate IS NULL) * 100.0::DOUBLE / count(*), 4) AS rate_missing_pct, round(count(*) FILTER (WHERE cash_rate = 0) * 100.0::DOUBLE / count(*), 4) AS cash_rate_missing_pct FROM h GROUP BY 1, 2")
def missing_field_report(spark, sf):
    n = F.count(F.lit(1))
    share = lambda c: F.round(F.count_if(c) * 100.0 / n, 4)
    return holdings(spark, sf).groupBy(*KEYS).agg(n.alias("n"), share(F.col("rate").isNull()).alias("rate_missing_pct"), share(F.col("cash_rate") == 0).alias("cash_rate_missing_pct"))


@query(HOLDINGS + "SELECT ticker, count(DISTINCT period) periods, max(period) latest, count(*) n FROM h GROUP BY 1")
def investments_index(spark, sf):
    return holdings(spark, sf).groupBy("ticker").agg(F.countDistinct("period").alias("periods"), F.max("period").alias("latest"), F.count(F.lit(1)).alias("n"))


@query(HOLDINGS + "SELECT max(latest) AS freshest, min(latest) AS stalest, count(*) tickers FROM (SELECT ticker, max(period) latest FROM h GROUP BY 1)")
def freshness(spark, sf):
    last = holdings(spark, sf).groupBy("ticker").agg(F.max("period").alias("latest"))
    return last.agg(F.max("latest").alias("freshest"), F.min("latest").alias("stalest"), F.count("ticker").alias("tickers"))
