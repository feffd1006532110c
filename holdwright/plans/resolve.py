"""Companies across funds: keys, ids, exposures, conflicts, clusters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import aggregate as A
from ..operators import cluster
from .binding import HOLDINGS, holdings, query, table

_KEY = "trim(regexp_replace(regexp_replace(replace(lower({0}), '&', ' and '), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"


@query(f"SELECT p_partkey, {_KEY.format('x')} AS key, split_part(lower(trim(x)), ' ', 1) AS block FROM (SELECT p_partkey, p_name || ' & Co., ' || p_brand AS x FROM part)")
def name_keys(spark, sf):
    x = F.concat("p_name", F.lit(" & Co., "), "p_brand")
    return table(spark, sf, "part").select("p_partkey", text.name_key(x).alias("key"), text.block_key(x).alias("block"))


@query("SELECT c_custkey, 'co_' || substr(sha256(lower(trim(c_name))), 1, 12) AS company_id FROM customer")
def stable_ids(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text.stable_id(F.col("c_name")).alias("company_id"))


@query("""WITH c AS (SELECT user_id, event_type, count(*) n, min(event_id) f FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) rn FROM c) SELECT user_id, event_type AS mode, n AS count FROM r WHERE rn = 1""")
def mode_first_seen(spark, sf):
    return A.mode_first(table(spark, sf, "events"), ["user_id"], "event_type", F.col("event_id"))


_MODE = """WITH d AS (SELECT doc_id, source, lang, quality FROM documents LEFT JOIN labels USING (doc_id)), k AS (SELECT doc_id, source, CASE WHEN quality IS NOT NULL THEN lang END AS lang FROM d),
  c AS (SELECT source, lang, count(*) n, min(doc_id) f FROM k WHERE lang IS NOT NULL GROUP BY 1, 2), m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, f) rn FROM c) WHERE rn = 1) """


@query(_MODE + "SELECT k.doc_id, coalesce(k.lang, m.lang, 'Other') AS lang, k.lang IS NULL AS filled FROM k LEFT JOIN m ON k.source = m.source")
def propagate_mode(spark, sf):
    """A label known for some rows (those with a quality label) fills the others of their source."""
    d = table(spark, sf, "documents").select("doc_id", "source", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    k = d.select("doc_id", "source", F.when(F.col("quality").isNotNull(), F.col("lang")).alias("lang"))
    m = A.mode_first(k, ["source"], "lang", F.col("doc_id")).drop("count")
    return k.join(m, "source", "left").select("doc_id", F.coalesce("lang", "mode", F.lit("Other")).alias("lang"), F.col("lang").isNull().alias("filled"))


_LATEST = HOLDINGS + """, l AS (SELECT h.* FROM h JOIN (SELECT ticker, max(period) AS period FROM h GROUP BY 1) m ON h.ticker = m.ticker AND h.period = m.period),
  s AS (SELECT *, CASE WHEN fv <= 0 THEN cost WHEN CAST(fv AS DOUBLE) / CAST(cost AS DOUBLE) > 500 THEN cost ELSE fv END AS safe FROM l) """


def safe_value():
    """Fair value, or cost where it is not positive or out of all proportion."""
    fv, cost = F.col("fv"), F.col("cost")
    return F.when(fv <= 0, cost).when(F.coalesce(F.try_divide(fv.cast("double"), cost.cast("double")), F.lit(0.0)) > 500, cost).otherwise(fv)


def latest(spark, sf):
    return A.latest(holdings(spark, sf), ["ticker"], "period").withColumn("safe", safe_value())


@query(_LATEST + """SELECT company, count(DISTINCT ticker) funds, string_agg(DISTINCT ticker, ',' ORDER BY ticker) tickers, CAST(sum(safe) AS DOUBLE) / 1000 AS exposure_m, round(avg(CASE WHEN cash_rate BETWEEN 0 AND 100 THEN cash_rate END), 6) AS rate FROM s GROUP BY 1""")
def company_exposures(spark, sf):
    rate = F.when(F.col("cash_rate").between(0, 100), F.col("cash_rate"))
    return latest(spark, sf).groupBy("company").agg(
        F.countDistinct("ticker").alias("funds"), F.array_join(F.array_sort(F.collect_set("ticker")), ",").alias("tickers"),
        (F.sum("safe").cast("double") / 1000).alias("exposure_m"), F.round(F.avg(rate), 6).alias("rate"),
    )


@query(_LATEST + """SELECT company, ticker, matures, kind, CAST(sum(safe) AS DOUBLE) fv FROM (SELECT company, ticker, CAST(matures AS BIGINT) AS matures, kind, safe FROM s WHERE safe > 0) GROUP BY GROUPING SETS ((company, ticker), (company, matures), (company, kind))""")
def exposure_sets(spark, sf):
    """By fund, by maturity and by type, from one scan."""
    h = latest(spark, sf).filter("safe > 0").withColumn("matures", F.col("matures").cast("long"))
    c = [F.col(x) for x in ("company", "ticker", "matures", "kind")]
    return h.groupingSets([[c[0], c[1]], [c[0], c[2]], [c[0], c[3]]], *c).agg(F.sum("safe").cast("double").alias("fv"))


@query(_LATEST + """, v AS (SELECT company, ticker, sum(safe) v FROM s GROUP BY 1, 2) SELECT company, ticker, round(CAST(v AS DOUBLE) * 100 / CAST(sum(v) OVER (PARTITION BY company) AS DOUBLE), 6) AS pct FROM v""")
def company_shares(spark, sf):
    v = latest(spark, sf).groupBy("company", "ticker").agg(F.sum("safe").alias("v"))
    return v.select("company", "ticker", F.round(F.col("v").cast("double") * 100 / F.sum("v").over(Window.partitionBy("company")).cast("double"), 6).alias("pct"))


@query(HOLDINGS + """, c AS (SELECT company, kind, count(*) n FROM h GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY n DESC, kind) rn, sum(n) OVER (PARTITION BY company) t, count(*) OVER (PARTITION BY company) k FROM c)
  SELECT company, kind AS top_kind, k AS kinds, round(n * 100.0::DOUBLE / t, 4) AS top_pct FROM r WHERE rn = 1 AND k >= 3 AND n * 100.0::DOUBLE / t < 60""")
def sector_conflicts(spark, sf):
    c = holdings(spark, sf).groupBy("company", "kind").agg(F.count(F.lit(1)).alias("n"))
    best = c.groupBy("company").agg(F.min(F.struct((-F.col("n")).alias("m"), "kind")).alias("b"), F.sum("n").alias("t"), F.count(F.lit(1)).alias("kinds"))
    share = -F.col("b.m") * 100.0 / F.col("t")
    return best.filter((F.col("kinds") >= 3) & (share < 60)).select("company", F.col("b.kind").alias("top_kind"), "kinds", F.round(share, 4).alias("top_pct"))


@query("""WITH d AS (SELECT DISTINCT p_name || ' ' || p_brand || ' ' || p_type AS x FROM part), w AS (SELECT x, string_split(x, ' ') AS w FROM d), p AS (SELECT array_to_string(w[1:k], ' ') AS prefix FROM (SELECT w, unnest(range(1, len(w))) AS k FROM w))
  SELECT prefix, count(*) n FROM p WHERE length(prefix) >= 10 GROUP BY 1 HAVING count(*) >= 2""")
def prefix_groups(spark, sf):
    x = table(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("x"))
    return cluster.common_prefixes(x, [], "x")


def part_names(spark, sf):
    return table(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_brand").alias("name")).distinct()


@query()
def similar_names(spark, sf):
    """Rows only: the score is a subsequence length, held against brute force in the tests."""
    pairs = cluster.similar_pairs(part_names(spark, sf), "name", text.block_key(F.col("name")))
    return pairs.withColumn("score", F.round("score", 4))


@query()
def company_index(spark, sf):
    name = F.col("name")
    found = cluster.clusters(part_names(spark, sf), "name", text.block_key(name), text.without_legal_form(name))
    return cluster.index(found, text.stable_id(F.col("canonical"))).withColumn("variants", F.array_join("variants", "|"))


@query(HOLDINGS + ", u AS (SELECT ticker, company, count(*) n, min(industry) industry FROM h GROUP BY 1, 2) SELECT ticker, company, n, industry FROM u")
def unique_companies(spark, sf):
    return holdings(spark, sf).groupBy("ticker", "company").agg(F.count(F.lit(1)).alias("n"), F.min("industry").alias("industry"))


@query(HOLDINGS + """, c AS (SELECT company, count(DISTINCT ticker) funds, CAST(sum(fv) AS DOUBLE) fv FROM h GROUP BY 1 HAVING count(DISTINCT ticker) >= 2) SELECT company, funds, fv FROM c ORDER BY funds DESC, fv DESC, company LIMIT 50""")
def top_by_exposure(spark, sf):
    c = holdings(spark, sf).groupBy("company").agg(F.countDistinct("ticker").alias("funds"), F.sum("fv").cast("double").alias("fv")).filter("funds >= 2")
    return c.orderBy(F.desc("funds"), F.desc("fv"), "company").limit(50)
