"""Data-quality checks: each returns the violating rows or keys."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once; a key with a null part is not compared."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.filter(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def relationship(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-null reference has no parent."""
    known = parent.select(F.col(parent_key).alias(column)).filter(F.col(column).isNotNull()).distinct()
    return df.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(values))


def one_parent(sky: DataFrame) -> DataFrame:
    """Sky layers that do not have exactly one parent."""
    return sky.filter(F.col("metar_fk").isNull() == F.col("taf_fk").isNull())


@dataclass(frozen=True)
class Check:
    """A declared check of one table.

    ``kind``: ``not_null``, ``unique``, ``accepted`` (``values``), ``relationship`` (``parent``
    table and its key) or ``condition`` (an SQL condition that a bad row fulfils).
    """

    name: str
    table: str
    kind: str
    columns: tuple[str, ...] = ()
    values: tuple[str, ...] = ()
    parent: tuple[str, str] = ("", "")
    condition: str = ""

    def bad(self) -> Column:
        """A violating row, for kinds that one row decides."""
        column = F.col(self.columns[0]) if self.columns else None
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "accepted":
            return column.isNotNull() & ~column.isin(*self.values)
        return F.expr(self.condition)

    def key(self) -> Column:
        """The value that rows are compared by; null if a part is null."""
        parts = [F.col(c).cast("string") for c in self.columns]
        present = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
        return F.when(present, F.to_json(F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])))


def _evidence(name: str, df: DataFrame, checks: list[Check]) -> DataFrame | None:
    """``check, key, rows, parent`` from one scan of a table: what its checks have to compare."""
    entries = []

    def entry(check: str, key: Column, wanted: Column, parent: bool) -> None:
        entries.append(F.when(wanted, F.struct(
            F.lit(check).alias("check"), key.alias("key"), F.lit(int(not parent)).cast("long").alias("rows"),
            F.lit(parent).alias("parent"),
        )))

    for check in checks:
        if check.kind == "relationship":
            if check.table == name:
                entry(check.name, check.key(), check.key().isNotNull(), False)
            if check.parent[0] == name:
                own = Check("", name, "unique", (check.parent[1],)).key()
                entry(check.name, own, own.isNotNull(), True)
        elif check.table == name:
            if check.kind == "unique":
                entry(check.name, check.key(), check.key().isNotNull(), False)
            else:
                entry(check.name, F.lit(None).cast("string"), check.bad(), False)
    if not entries:
        return None
    return df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")


def report(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check with its number of violations; every table is read once.

    Rows are counted per check and value before they are shuffled, so a value that
    a third of all rows share costs one row per task.
    """
    spark = next(iter(tables.values())).sparkSession
    parts = [p for name, df in tables.items() if (p := _evidence(name, df, checks)) is not None]
    counted = reduce(DataFrame.unionByName, parts).groupBy("check", "key").agg(
        F.sum("rows").alias("rows"), F.max("parent").alias("parent")
    )
    kinds = spark.createDataFrame([(c.name, c.kind) for c in checks], "check string, kind string")
    judged = counted.join(F.broadcast(kinds), "check").select(
        "check",
        F.when(F.col("kind") == "unique", (F.col("rows") > 1).cast("long"))
        .when(F.col("kind") == "relationship", F.when(F.col("parent"), 0).otherwise(F.col("rows")))
        .otherwise(F.col("rows")).cast("long").alias("violations"),
    )
    every = kinds.select("check", F.lit(0).cast("long").alias("violations"))
    return judged.unionByName(every).groupBy("check").agg(F.sum("violations").alias("violations"))


def dimension_checks() -> list[Check]:
    """The declared checks of the five dimensions."""
    route_key = ("airline_iata", "source_airport_iata", "dest_airport_iata")
    checks = [
        *[Check(f"{t}.{c} unique", t, "unique", (c,)) for t, c in (
            ("countries", "code"), ("airlines", "id"), ("airlines", "iata"), ("airports", "iata_code"))],
        *[Check(f"{t}.{c} not_null", t, "not_null", (c,)) for t, c in (
            ("countries", "code"), ("airlines", "id"), ("airlines", "iata"), ("airports", "id"), ("runways", "id"),
            ("runways", "airport_ref"), *[("routes", c) for c in route_key])],
        Check("airlines.active accepted", "airlines", "accepted", ("active",), values=("Y", "N")),
        Check("routes key unique", "routes", "unique", route_key),
    ]
    for table, column, parent in (
        ("airlines", "country_code", ("countries", "code")), ("airports", "iso_country", ("countries", "code")),
        ("runways", "airport_ref", ("airports", "id")),
    ):
        checks.append(Check(f"{table}.{column} relationship", table, "relationship", (column,), parent=parent))
    return checks


def weather_checks() -> list[Check]:
    """References between flights, reports, forecasts and sky layers."""
    checks = [
        Check(f"{table}.{column}", table, "relationship", (column,), parent=(parent, "id"))
        for table, column, parent in (
            ("flight", "departure_metar_fk", "metar"), ("flight", "arrival_taf_fk", "taf"),
            ("sky", "metar_fk", "metar"), ("sky", "taf_fk", "taf"),
        )
    ]
    checks.append(Check("sky.one_parent", "sky", "condition", condition="(metar_fk is null) = (taf_fk is null)"))
    return checks + [Check(f"{t}.external_id unique", t, "unique", ("external_id",)) for t in ("metar", "taf")]


# ---- checks while writing --------------------------------------------------------------

# Kinds that one row decides; uniqueness and references need other rows.
ROW_KINDS = ("not_null", "accepted", "condition")


def observed(df: DataFrame, table: str, checks: list[Check]) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows and violations while it is written, without a scan of its own.

    The counts are there once an action has run: see ``violations``.
    """
    own = [c for c in checks if c.table == table and c.kind in ROW_KINDS]
    seen = Observation()
    counts = [F.count(F.when(c.bad(), 1)).alias(c.name) for c in own]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def violations(spark: SparkSession, seen: dict[str, Observation]) -> DataFrame:
    """``check, violations`` of all written tables; a row per check."""
    found = [(name, n) for observation in seen.values() for name, n in observation.get.items() if name != "rows"]
    return spark.createDataFrame(found, "check string, violations long")


def write_checked(tables: dict[str, DataFrame], root: str, checks: list[Check]) -> DataFrame:
    """Write each table below ``root`` and return the violations that were counted on the way."""
    spark, seen = next(iter(tables.values())).sparkSession, {}
    for name, df in tables.items():
        watched, seen[name] = observed(df, name, checks)
        watched.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")
    return violations(spark, seen)
