"""Holdings files: CSV whose header decides the columns, one file a fund and period."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse

# The fact table's columns; all are text in the files, money in thousands.
COLUMNS = [
    "company_name", "company_id", "investment_type", "industry", "cash_rate", "pik_rate", "reference_rate", "spread", "floor_rate", "acquisition_date",
    "maturity_date", "principal_amount", "amortized_cost", "fair_value", "percent_of_net_assets", "cost", "commitment_limit", "undrawn_commitment",
    "rate_cap", "shares", "data_quality_flags",
]
MONEY = ["principal_amount", "amortized_cost", "fair_value", "cost", "commitment_limit", "undrawn_commitment"]
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS] + [T.StructField("row_seq", T.LongType()), T.StructField("path", T.StringType())])
ALIASES = {"floor": "floor_rate"}


def read_csv_holdings(spark: SparkSession, path: str) -> DataFrame:
    """All files under path, by their own headers: unknown columns are left out, missing ones
    are null, a name that comes twice keeps its first. ticker and filing_date come from
    ``.../TICKER/YYYY-MM-DD.csv``; files with other names are not read. row_seq is the
    order within the file. Nameless rows are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(path).select("path", "content")
    files = files.filter(F.col("path").rlike(r"/[^/]+/\d{4}-\d{2}-\d{2}\.csv$"))

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                lines = csv.reader(io.StringIO(content.decode("utf-8-sig", "replace"), newline=""))
                head = [ALIASES.get(h.strip(), h.strip()) for h in next(lines, [])]
                at = {c: head.index(c) for c in COLUMNS if c in head}
                out = [[line[at[c]] if c in at and at[c] < len(line) else None for c in COLUMNS] + [k, name] for k, line in enumerate(lines)]
                yield pd.DataFrame(out, columns=[*COLUMNS, "row_seq", "path"])

    d = files.mapInPandas(rows, SCHEMA)
    d = d.withColumn("ticker", F.upper(F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1)))
    d = d.withColumn("filing_date", F.to_date(F.regexp_extract("path", r"(\d{4}-\d{2}-\d{2})\.csv$", 1))).drop("path")
    return d.filter(F.trim(F.coalesce("company_name", F.lit(""))) != "")


def typed(holdings: DataFrame) -> DataFrame:
    """Adds numbers and dates beside the text: name_num for money, rates and shares, name_dt for dates."""
    numbers = [*MONEY, "percent_of_net_assets", "shares", "cash_rate", "pik_rate", "spread", "floor_rate", "rate_cap"]
    d = holdings.withColumns({f"{c}_num": parse.to_double(F.col(c)) for c in numbers})
    return d.withColumns({f"{c}_dt": parse.parse_date(F.col(c)) for c in ("acquisition_date", "maturity_date")})


def write_holdings(holdings: DataFrame, path: str) -> None:
    """Parquet by fund and period; a period written again replaces itself alone."""
    holdings.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ticker", "filing_date").parquet(path)


def not_landed(found: DataFrame, landed: DataFrame) -> DataFrame:
    """What has not been written yet."""
    return found.join(landed.select("ticker", "filing_date").distinct(), ["ticker", "filing_date"], "left_anti")


def index(holdings: DataFrame) -> DataFrame:
    """(ticker, periods, latest, row_count)"""
    return holdings.groupBy("ticker").agg(F.array_sort(F.collect_set("filing_date")).alias("periods"), F.max("filing_date").alias("latest"), F.count(F.lit(1)).alias("row_count"))


def write_json(docs: DataFrame, path: str, by: str) -> None:
    """A JSON document a row, in folders by a column."""
    rest = [c for c in docs.columns if c != by]
    docs.select(by, F.to_json(F.struct(*rest)).alias("value")).write.mode("overwrite").partitionBy(by).text(path)
