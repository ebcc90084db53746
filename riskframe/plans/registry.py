"""Query registry. One decorator keeps a query and its SQL next to each other."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.plans.views import VIEW_SQL

Query = Callable[[SparkSession, str], DataFrame]
NUDGE = "1.00000000000001"
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def oracle_text(body: str, views: Sequence[str] = (), doubles: str = "", digits: int = 6) -> str:
    """The body with its views as CTEs and its double columns rounded."""
    ctes = [f"{v} AS ({VIEW_SQL[v]})" for v in views]
    text = body.strip()
    if text[:5].upper() == "WITH ":
        head, rest = "WITH ", text[5:]
        text = head + ", ".join([*ctes, rest]) if ctes else text
    elif ctes:
        text = "WITH " + ", ".join(ctes) + " " + text
    if doubles:
        parts = ", ".join(f"round(CAST({c} AS DOUBLE) * {NUDGE}::DOUBLE, {digits}) + 0.0 AS {c}" for c in doubles.split())
        text = f"SELECT * REPLACE ({parts}) FROM ({text})"
    return text


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded (and -0.0 made 0.0) so that summation order does not show.

    Engines break decimal ties differently; the nudge, below double precision of the result, moves
    every tie to the same side.
    """
    return df.select(*[(F.round(F.col(f"`{n}`") * F.lit(float(NUDGE)), digits) + F.lit(0.0)).alias(n) if t == "double" else F.col(f"`{n}`")
                       for n, t in df.dtypes])


def query(key: str, sql: str | None = None, views: Sequence[str] = (), doubles: str = "", digits: int = 6):
    """Registers ``f(spark, sf_dir)``; ``doubles`` names the columns rounded on both sides."""
    def wrap(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir), digits)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = oracle_text(sql, views, doubles, digits)
        return fn
    return wrap
