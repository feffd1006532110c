"""Documents and pages: plain text, search, classifiers, figures near a phrase."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import needles as needles_
from .binding import query, table


@query("""SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
  '&nbsp;', ' '), '&#160;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))) AS digest FROM pages""")
def html_plain_text(spark, sf):
    t = text.strip_markup(F.col("html"))
    return table(spark, sf, "pages").select("page_id", F.md5(t.cast("binary")).alias("digest"))


@query("SELECT page_id, url FROM pages WHERE contains(lower(html), 'charset') AND contains(lower(url), 'en')")
def text_search(spark, sf):
    return table(spark, sf, "pages").filter(F.lower("html").contains("charset") & F.lower("url").contains("en")).select("page_id", "url")


@query("""WITH n AS (SELECT DISTINCT substr(text, CAST(item_id % 40 + 1 AS INT), CAST(item_id % 17 + 1 AS INT)) AS needle FROM benchmark)
  SELECT needle, n_chars AS "order", doc_id AS id FROM n JOIN documents ON contains(text, needle) WHERE needle <> '' QUALIFY row_number() OVER (PARTITION BY needle ORDER BY n_chars, doc_id) = 1""")
def first_hits(spark, sf):
    """Pieces of the benchmark's items, one to seventeen characters long, and the shortest document that holds each."""
    i = F.col("item_id")
    needles = table(spark, sf, "benchmark").select(F.substring("text", (i % 40 + 1).cast("int"), (i % 17 + 1).cast("int")).alias("needle"))
    return needles_.first_hits(table(spark, sf, "documents"), needles, "doc_id", "text", "n_chars", "needle")


@query("""SELECT doc_id, contains(lower(text), 'license') AS "primary", (contains(lower(text), 'the'))::INT + (contains(lower(text), 'and'))::INT + (contains(lower(text), 'token'))::INT AS secondary FROM documents WHERE contains(lower(text), 'license') OR (contains(lower(text), 'the'))::INT + (contains(lower(text), 'and'))::INT + (contains(lower(text), 'token'))::INT >= 2""")
def classify_texts(spark, sf):
    low = F.lower("text")
    second = sum((low.contains(w).cast("int") for w in ("the", "and", "token")), F.lit(0))
    d = table(spark, sf, "documents").select("doc_id", low.contains("license").alias("primary"), second.alias("secondary"))
    return d.filter("primary or secondary >= 2")


@query("""SELECT doc_id, len(regexp_extract_all(text, '[0-9]+')) AS numbers, regexp_extract(text, '([0-9]{3,})', 1) AS first_long FROM documents WHERE regexp_matches(text, '[0-9]{3,}')""")
def numbers_in_text(spark, sf):
    d = table(spark, sf, "documents").filter(F.col("text").rlike("[0-9]{3,}"))
    return d.select("doc_id", F.regexp_count("text", F.lit("[0-9]+")).cast("long").alias("numbers"), F.regexp_extract("text", "([0-9]{3,})", 1).alias("first_long"))


@query("""SELECT source, lang, count(*) n, CAST(sum(length(text)) AS BIGINT) chars, CAST(max(length(text)) AS BIGINT) longest FROM documents GROUP BY 1, 2""")
def corpus_profile(spark, sf):
    n = F.length("text").cast("long")
    return table(spark, sf, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.sum(n).alias("chars"), F.max(n).alias("longest"))
