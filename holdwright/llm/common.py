"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..operators.shared import connected_components, forget, materialize, shared_dir  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them until no column of df has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        out.append(n)
    return out


def ascii_lower(c):
    """Lower-case A-Z alone; lower() is the quick test that most words need no change."""
    return F.when(F.lower(c) == c, c).otherwise(F.translate(c, UPPER, UPPER.lower()))


def arrow_schema(ddl: str):
    """The Arrow schema of a DDL one, for tasks, which have no session to read DDL with."""
    return to_arrow_schema(StructType.fromDDL(ddl))
