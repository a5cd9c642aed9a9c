"""Check every table of a run and keep the failures."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from sitegrade import fixed_values as fixed
from sitegrade.functions.dates import AsOf, resolved
from sitegrade.operators.quality import check_tables, failing_rows, freshness, repeated_values
from sitegrade.sources.sinks import TableStore

LAYER = "audit"


def audit(
    tables: Mapping[str, DataFrame],
    store: TableStore,
    checks: Mapping[str, Mapping] = fixed.DATA_CHECKS,
    feeds: Mapping[str, str] = fixed.FRESHNESS_FEEDS,
    as_of: AsOf = None,
) -> DataFrame:
    """Store the failing rows of every check and return the stored report.

    The age of each of ``feeds`` (table, load column) that is among the tables
    is stored beside it, as ``audit/freshness``.

    A table's failing rows lie under ``audit/{table}``, one folder per check and
    column; repeated values of a unique column under ``audit/{table}_{column}``.
    """
    for name in tables.keys() & checks.keys():
        failures = failing_rows(tables[name], checks[name])
        writer = failures.write.mode("overwrite").partitionBy("check_name", "column_name")
        writer.parquet(store.path(LAYER, name))
        for column in checks[name].get("unique", []):
            store.save(repeated_values(tables[name], column), LAYER, f"{name}_{column}")
    given = {name: column for name, column in feeds.items() if name in tables}
    if given:
        day = resolved(next(iter(tables.values())).sparkSession, as_of)
        ages = [freshness(tables[name], name, column, day) for name, column in given.items()]
        store.save(reduce(DataFrame.unionByName, ages), LAYER, "freshness")
    return store.save(check_tables(tables, checks), LAYER, "report")
