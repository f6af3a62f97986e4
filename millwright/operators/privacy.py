"""Pseudonyms, retention and erasure on raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millwright.sources import layout


def pseudonym(identifier: Column, salt: str) -> Column:
    """The SHA-256 of salt and identifier; NULL stays NULL. Equal identifiers keep equal digests, so joins and counts per
    identifier still hold. The salt's length goes first: no other salt and identifier give the same text."""
    return F.sha2(F.concat(F.lit(f"{len(salt)}:{salt}:"), identifier.cast("string")), 256)


def pseudonymised(rows: DataFrame, columns: list[str], salt: str) -> DataFrame:
    return rows.withColumns({c: pseudonym(F.col(c), salt) for c in columns})


def retain(spark: SparkSession, path: str, contract: T.StructType, oldest: str) -> list[str]:
    """Remove the rows of a raw table from before ``oldest`` (yyyy-mm-dd); returns the folders that went.

    Earlier months go unread, as whole folders. Only where ``oldest`` lies inside a month, that month is read, and its
    folders with an older row are rewritten. Rows without a month are kept.
    """
    first = f"{oldest[:7]}-01"
    now = [u for u in layout.live(spark, path) if u.month != layout.NO_MONTH]
    old = [u for u in now if u.month < first]
    ts = layout.event_time(contract)
    edge = [u for u in now if u.month == first] if oldest > first else []
    is_old = F.col(ts) < F.lit(oldest).cast("timestamp")
    touched = _with_such_rows(layout.read_units(spark, path, contract, edge).where(is_old), edge) if edge else []
    if old or touched:
        kept = layout.read_units(spark, path, contract, touched).where(~is_old)
        layout.rewrite(spark, path, contract, "retain", kept, old + touched)
    return [u.folder for u in old + touched]


def _with_such_rows(rows: DataFrame, units: list[layout.Unit]) -> list[layout.Unit]:
    """Those of the folders that the rows come from."""
    found = {
        (str(r["event_month"]) if r["event_month"] else layout.NO_MONTH, r["batch"])
        for r in rows.select("event_month", "batch").distinct().collect()  # names of folders
    }
    return [u for u in units if (u.month, u.batch) in found]


def erase(spark: SparkSession, path: str, contract: T.StructType, column: str, erased: DataFrame) -> int:
    """Remove the rows whose ``column`` is among ``erased`` (one column of that name); returns the folders touched.

    Only folders with such a row are rewritten. The replacement takes effect as a whole, so readers see either all
    rows or none of the erased ones, and a run that failed is repeated. Folders that a run before left behind are
    deleted first. Rows with a NULL identifier stay.
    """
    layout.vacuum(spark, path, hours=0)
    wanted = erased.select(column).where(F.col(column).isNotNull()).distinct()
    now = layout.live(spark, path)
    touched = _with_such_rows(layout.read_units(spark, path, contract, now).join(wanted, column, "left_semi"), now)
    if touched:
        kept = layout.read_units(spark, path, contract, touched).join(wanted, column, "left_anti")
        layout.rewrite(spark, path, contract, "erase", kept.select(*contract.names, "event_month", "batch"), touched)
    return len(touched)
