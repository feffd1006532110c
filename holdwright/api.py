"""One method for every question that a portfolio's page asks, as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .operators import aggregate as A
from .operators import joins, order, rank


class Portfolio:
    """Holdings (ticker, filing_date, company_name, fair_value, ...) and, by name, the tables beside
    them: financials, filings, credit, profiles, quality, companies. Nothing runs until a result is used."""

    def __init__(self, holdings: DataFrame, **tables: DataFrame):
        self.rows, self.tables = holdings, tables

    def _of(self, df: DataFrame, ticker: str) -> DataFrame:
        return df.filter(F.upper("ticker") == ticker.upper())

    def tickers(self) -> DataFrame:
        return self.rows.groupBy("ticker").agg(F.countDistinct("filing_date").alias("periods"), F.max("filing_date").alias("latest"), F.count(F.lit(1)).alias("row_count"))

    def periods(self, ticker: str) -> DataFrame:
        return self._of(self.rows, ticker).select("filing_date").distinct().orderBy("filing_date")

    def holdings(self, ticker: str, period: str | None = None) -> DataFrame:
        """Positions of a period, of the last where none is given."""
        rows = self._of(self.rows, ticker)
        return rows.filter(F.col("filing_date") == F.to_date(F.lit(period))) if period else A.latest(rows, ["ticker"], "filing_date")

    def table(self, name: str, ticker: str | None = None) -> DataFrame:
        """financials, filings, credit, profiles, quality or companies; of one fund where it is given."""
        return self._of(self.tables[name], ticker) if ticker else self.tables[name]

    def mix(self, ticker: str, by: str, value: str = "fair_value") -> DataFrame:
        return A.breakdown(self._of(self.rows, ticker), ["filing_date"], by, {value: F.sum(value), "n": F.count(F.lit(1))}, value)

    def slice(self, ticker: str, period: str | None, condition: Column, value: str = "fair_value") -> DataFrame:
        """Positions, value and share of those that meet a condition: one row."""
        ok = F.coalesce(condition, F.lit(False))
        total = F.sum(value)
        part = F.coalesce(F.sum(F.when(ok, F.col(value))), F.lit(0))
        return self.holdings(ticker, period).agg(F.count_if(ok).alias("n"), part.alias(value), F.try_divide(part * 100, total).alias("pct"))

    def search(self, text: str, columns: list[str]) -> DataFrame:
        """Rows in which any of the columns has the text."""
        hit = F.lit(False)
        for c in columns:
            hit = hit | F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))).contains(text.lower())
        return self.rows.filter(hit)

    def changes(self, ticker: str, before: str, after: str, value: str = "fair_value") -> DataFrame:
        """Two periods by company: before, after, delta, status."""
        side = lambda p: self.holdings(ticker, p).groupBy("company_name").agg(F.sum(value).alias(value))
        return joins.difference(side(before), side(after), ["company_name"], value)

    def history(self, ticker: str, value: str = "fair_value") -> DataFrame:
        """Totals by period with the period before and the trailing median."""
        t = self._of(self.rows, ticker).groupBy("ticker", "filing_date").agg(F.sum(value).alias(value), F.count(F.lit(1)).alias("row_count"))
        return order.trailing_median(order.previous(t, ["ticker"], "filing_date", [value, "row_count"]), ["ticker"], "filing_date", value)

    def peers(self, metrics: Mapping[str, Column]) -> DataFrame:
        """A row of aggregates for each fund's last period."""
        return A.latest(self.rows, ["ticker"], "filing_date").groupBy("ticker").agg(*[c.alias(n) for n, c in metrics.items()])

    def scorecard(self, metrics: Mapping[str, Column], lower_is_better: tuple[str, ...] = ()) -> DataFrame:
        """Percentile scores of every fund and metric."""
        long = rank.long_metrics(self.peers(metrics), ["ticker"], list(metrics))
        worst_first = F.when(F.col("metric").isin(list(lower_is_better) or [""]), -F.col("value")).otherwise(F.col("value"))
        return rank.percentile_score(long, ["metric"], worst_first)

    def freshness(self) -> DataFrame:
        last = self.rows.groupBy("ticker").agg(F.max("filing_date").alias("latest"))
        return last.agg(F.max("latest").alias("freshest"), F.min("latest").alias("stalest"), F.count("ticker").alias("tickers"))
