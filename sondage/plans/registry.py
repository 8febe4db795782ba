"""All registered queries and their SQL: each is an operator over the driver's tables, results rounded to 6 places."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of a table reader as a query, with its SQL where there is one."""

    def register(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__name__ = name
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return f

    return register


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 places, NaN as null."""
    return df.select(*[F.round(F.nanvl(F.col(c), F.lit(None)), 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def settled(df: DataFrame) -> DataFrame:
    """Doubles rounded to 10 places and then to 6, so that noise in the last bits of a half doesn't decide."""
    return df.select(*[F.round(F.round(F.nanvl(F.col(c), F.lit(None)), 10), 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r6(x: str) -> str:
    """SQL of the same."""
    return f"CAST(round(CAST({x} AS DECIMAL(28, 10)), 6) AS DOUBLE)"


def settled_sql(sql: str) -> str:
    """``sql`` with every ``round(x, 6)`` as ``r6(x)``."""
    out, at = "", 0
    while (start := sql.find("round(", at)) >= 0:
        depth, end = 1, start + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[start + 6 : end - 1]
        plain = inner.endswith(", 6") and "DECIMAL(28, 10)" not in inner
        out += sql[at:start] + (r6(inner.removesuffix(", 6")) if plain else sql[start:end])
        at = end
    return out + sql[at:]


def profiles(read) -> DataFrame:
    """Order lines as casts: depth is the quantity, temperature a share of the price, sequence the line's own key."""
    return read("lineitem").select(
        F.col("l_orderkey").alias("cast_key"), "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_suppkey") % 8 + 1).alias("estacion"), F.col("l_quantity").alias("profundidad_m"), (F.col("l_extendedprice") / 3000).alias("temperatura_c"), F.col("l_shipdate").alias("fecha")
    )


SEQ = ["l_linenumber", "l_partkey", "l_suppkey"]
PROFILES_SQL = """profiles AS (SELECT l_orderkey AS cast_key, l_linenumber, l_partkey, l_suppkey, l_suppkey % 8 + 1 AS estacion,
  l_quantity AS profundidad_m, l_extendedprice / 3000 AS temperatura_c, l_shipdate AS fecha FROM lineitem)"""


def monthly_orders(read) -> DataFrame:
    """Orders by nation and month: ``series_id, month, value``."""
    from sondage.operators.series import monthly_mean

    o = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return monthly_mean(o.select(F.col("c_nationkey").alias("series_id"), "o_orderdate", (F.col("o_totalprice") / 10000).alias("v")), ["series_id"], "o_orderdate", "v")


MONTHLY_SQL = """monthly AS (SELECT c_nationkey AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(sum(CAST(o_totalprice / 10000 AS DECIMAL(28, 12))) AS DOUBLE) / count(o_totalprice) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


def customer_months(read) -> DataFrame:
    """Orders by customer and month, with missing months: ``series_id, month, value``."""
    from sondage.operators.series import monthly_mean

    o = read("orders").select(F.col("o_custkey").alias("series_id"), "o_orderdate", (F.col("o_totalprice") / 10000).alias("v"))
    return monthly_mean(o, ["series_id"], "o_orderdate", "v")


CUSTOMER_MONTHS_SQL = """monthly AS (SELECT o_custkey AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(sum(CAST(o_totalprice / 10000 AS DECIMAL(28, 12))) AS DOUBLE) / count(o_totalprice) AS value
  FROM orders GROUP BY ALL)"""

from . import queries_contract, queries_files, queries_rows, queries_scores, queries_series, queries_text  # noqa: E402, F401
