"""Named queries over the driver's tables, each with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.inputs import DIRTY_SQL, PREDICTIONS_SQL, UNITS_SQL
from riskloom.functions.columns import tidy

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    query: Query
    oracle: str | None


ENTRIES: dict[str, Entry] = {}

_VIEWS = {
    "units": UNITS_SQL,
    "dirty": DIRTY_SQL,
    "oof": PREDICTIONS_SQL,
}


def rounded(df: DataFrame, places: int = 9) -> DataFrame:
    """Round every double column for reporting."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: tidy(name, places) for name in doubles}) if doubles else df


def oracle_text(body: str, doubles: str, views: tuple[str, ...], places: int) -> str:
    """Complete SQL: the input views, the query, and the same rounding."""
    ctes = ",\n".join(f"{v} as ({_VIEWS[v]})" for v in views)
    names = doubles.split()
    replaced = ", ".join(f"round({n}, {places}) + 0e0 as {n}" for n in names)
    outer = f"select * replace ({replaced})" if names else "select *"
    # The body may start with its own CTEs.
    body = body.strip()
    if body.lower().startswith("with "):
        ctes, body = f"{ctes},\n{body[5:]}" if ctes else body[5:], ""
        head, _, tail = ctes.rpartition("\nfinal ")
        return f"with {head.rstrip().rstrip(',')}\n{outer} from ({tail})"
    return (f"with {ctes}\n" if ctes else "") + f"{outer} from ({body})"


def register(
    name: str,
    oracle: str | None = None,
    doubles: str = "",
    views: tuple[str, ...] = ("units",),
    places: int = 9,
) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is its SQL over the named input views.

    A body with own CTEs ends with a line ``final select ...``.
    """

    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(query(spark, sf_dir), places)

        text = oracle_text(oracle, doubles, views, places) if oracle else None
        ENTRIES[name] = Entry(run, text)
        return query

    return add
