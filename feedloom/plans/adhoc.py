"""Ad-hoc read-only SELECT over named views.

A convenience, not a security boundary: a Spark SELECT can read any path it can name.
"""

from __future__ import annotations

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from feedloom.operators.layout import to_json_rows

# Fixed value: the query that runs when none is given.
DEFAULT_QUERY = "SELECT city, count(*) AS readings FROM weather GROUP BY city ORDER BY city"


def only_select(spark: SparkSession, q: str) -> None:
    """Raise unless ``q`` is a query. Spark's own grammar decides: a common table expression holds a
    query and nothing else, so writes, commands and several statements fail to parse there; nothing is run."""
    try:
        spark._jsparkSession.sessionState().sqlParser().parsePlan(f"WITH q AS (\n{q}\n) SELECT 1")
    except ParseException as e:
        raise ValueError("only a single read-only query is accepted") from e


def adhoc(spark: SparkSession, views: dict[str, DataFrame], q: str | None = None, limit: int | None = None) -> DataFrame:
    """Run one query (SELECT, or WITH ... SELECT) over ``views``; all rows unless a ``limit`` is asked for."""
    q = (q or DEFAULT_QUERY).strip()
    only_select(spark, q)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    out = spark.sql(q)
    return out if limit is None else out.limit(limit)


def adhoc_json(spark: SparkSession, views: dict[str, DataFrame], q: str | None = None, limit: int | None = None) -> DataFrame:
    return to_json_rows(adhoc(spark, views, q, limit))
