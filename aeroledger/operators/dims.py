"""Airline, airport, country, route and runway dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import similar_names


def null_markers(df: DataFrame, marker: str = "\\N") -> DataFrame:
    """The null marker of the public files becomes null in every text column."""
    return df.select(*[
        F.nullif(F.col(c), F.lit(marker)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes
    ])


def fleet_age(rows: DataFrame, name: str, alias: str) -> DataFrame:
    """Typed fleet ages; text that is no number becomes null."""
    return rows.select(
        F.col(name).alias(alias),
        F.expr("try_cast(Average_Age as decimal(10,2))").alias("average_age"),
        F.expr("try_cast(Place as int)").alias("place"),
    )


# ---- countries ---------------------------------------------------------------

def country_matches(countries: DataFrame, fleet: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Country and fleet names that are each other's best match.

    Best by score on both sides; ties go to the smaller code and name. Both
    choices are aggregates over the candidate pairs, not windows.
    """
    pairs = similar_names(countries, "name", fleet, "country_name", threshold)
    candidates = (
        pairs.join(countries.select("id", "code", "name"), "name")
        .join(fleet.select("country_name", "average_age"), "country_name")
        .select("id", "code", "country_name", "average_age", "score")
    )
    for_name = candidates.groupBy("country_name").agg(
        F.min(F.struct((-F.col("score")).alias("worst"), "code", "id", "average_age")).alias("best")
    )
    for_code = candidates.groupBy("code").agg(
        F.min(F.struct((-F.col("score")).alias("worst"), "country_name", "id")).alias("best")
    ).select("code", "best.country_name")
    return for_name.select(
        "best.id", "best.code", "country_name", "best.average_age", (-F.col("best.worst")).alias("score")
    ).join(for_code, ["code", "country_name"], "left_semi")


def dim_countries(countries: DataFrame, fleet: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Matched countries under their fleet name, all others under their own."""
    matched = country_matches(countries, fleet, threshold)
    return with_unmatched(matched, countries)


def with_unmatched(matched: DataFrame, countries: DataFrame) -> DataFrame:
    others = countries.join(matched.select("id"), "id", "left_anti").select(
        "id", "code", F.col("name").alias("country_name")
    )
    return matched.select("id", "code", "country_name", "average_age", "score").unionByName(
        others, allowMissingColumns=True
    )


# ---- airlines ----------------------------------------------------------------

def _yes(column: str) -> Column:
    return F.upper(F.col(column)) == "Y"


def dim_airlines(
    airlines: DataFrame, countries: DataFrame, fleet: DataFrame, previous: DataFrame | None = None
) -> DataFrame:
    """Airlines with a usable code, their country code, fleet age and active flag."""
    country = countries.select("country_name", F.col("code").alias("country_code"))
    age = fleet.select(F.upper("Brand").alias("brand_key"), "average_age")
    source = (
        airlines.filter((F.length("iata") == 2) | (F.length("icao") == 3))
        .withColumn("brand_key", F.upper("name"))
        .join(country, "country_name", "left")
        .join(age, "brand_key", "left")
        .select("id", "name", "iata", "icao", "country_code", "average_age", "active")
    )
    return active_flag(source, previous)


def active_flag(source: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Active flag as Y or N.

    A stored flag changes only when the source states the opposite; an airline
    not stored yet follows the rule of the first load.
    """
    first = F.when(_yes("active"), "Y").otherwise("N")
    if previous is None:
        return source.withColumn("active", first)
    stored = previous.select("id", F.col("active").alias("stored"), F.lit(True).alias("known"))
    flag = (
        F.when(F.col("known").isNull(), first)
        .when((F.col("stored") == "Y") & (F.upper("active") == "N"), "N")
        .when((F.col("stored") == "N") & _yes("active"), "Y")
        .otherwise(F.col("stored"))
    )
    return source.join(stored, "id", "left").withColumn("active", flag).drop("stored", "known")


def active_duplicates(airlines: DataFrame) -> DataFrame:
    """IATA codes held by more than one active airline."""
    return (
        airlines.filter(F.coalesce("iata", F.lit("")) != "")
        .groupBy("iata").agg(F.count(F.when(_yes("active"), 1)).alias("active_rows"))
        .filter("active_rows > 1")
    )


def name_ratio(name: Column, stated: Column) -> Column:
    """One minus the edit distance over the longer length, case ignored; 0 without a name."""
    a, b = F.lower(F.coalesce(name, F.lit(""))), F.lower(F.coalesce(stated, F.lit("")))
    longer = F.greatest(F.char_length(a), F.char_length(b))
    return F.when((a != "") & (b != ""), 1 - F.levenshtein(a, b) / longer).otherwise(F.lit(0.0))


def exact_authority_match(candidates: DataFrame, authority: DataFrame) -> DataFrame:
    """First airline per IATA code whose ICAO code or name an authority entry states."""
    by_icao = authority.select("iata", F.upper("icao").alias("k")).filter("k <> ''").distinct()
    by_name = authority.select("iata", F.lower("name").alias("k")).filter("k <> ''").distinct()
    same_icao = candidates.withColumn("k", F.upper("icao")).join(by_icao, ["iata", "k"], "left_semi")
    same_name = candidates.withColumn("k", F.lower("name")).join(by_name, ["iata", "k"], "left_semi")
    return (
        same_icao.unionByName(same_name).groupBy("iata").agg(F.min("id").alias("id"))
    )


def authority_match(candidates: DataFrame, authority: DataFrame) -> DataFrame:
    """Chosen airline per IATA code: (iata, id, rule).

    An exact ICAO or name match wins, the first one in file order; only codes
    without one are compared by name ratio, over distinct names of each code. A code
    has a handful of names on either side; the pairs are rows, not lists.
    """
    exact = exact_authority_match(candidates, authority)
    rest = candidates.join(exact.select("iata"), "iata", "left_anti")
    own = rest.groupBy("iata", "name").agg(F.min("id").alias("id"))
    stated = authority.select("iata", F.coalesce("name", F.lit("")).alias("stated")).distinct()
    compared = own.join(stated, "iata").withColumn("ratio", name_ratio(F.col("name"), F.col("stated")))
    nearest = compared.groupBy("iata").agg(
        F.min(F.struct((-F.col("ratio")).alias("worst"), "id")).alias("best")
    )
    return exact.select("iata", "id", F.lit("exact").alias("rule")).unionByName(
        nearest.select("iata", "best.id", F.lit("nearest").alias("rule"))
    )


def clear_active_duplicates(airlines: DataFrame, authority: DataFrame) -> DataFrame:
    """Keep one active row per duplicated IATA code, set the others to N.

    As in the original cleaning, a duplicated code that the authority does not
    know at all loses every active mark.
    """
    repeated = active_duplicates(airlines).select("iata")
    contested = airlines.filter(_yes("active")).join(repeated, "iata", "left_semi")
    chosen = authority_match(contested, authority).select("iata", F.col("id").alias("chosen"))
    marked = airlines.join(repeated.withColumn("repeated", F.lit(True)), "iata", "left").join(
        chosen, "iata", "left"
    )
    loses = F.col("repeated").isNotNull() & _yes("active") & ~F.coalesce(F.col("id") == F.col("chosen"), F.lit(False))
    return marked.withColumn("active", F.when(loses, "N").otherwise(F.col("active"))).select(*airlines.columns)


def one_row_per_iata(airlines: DataFrame, authority: DataFrame) -> DataFrame:
    """One airline per IATA code; blank codes dropped.

    A repeated code keeps its authority match, or its first row if the
    authority does not know the code.
    """
    coded = airlines.filter(F.coalesce("iata", F.lit("")) != "")
    sizes = coded.groupBy("iata").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
    repeated = coded.join(sizes.filter("n > 1").select("iata"), "iata", "left_semi")
    chosen = authority_match(repeated, authority).select("iata", F.col("id").alias("chosen"))
    keep = sizes.join(chosen, "iata", "left").select(F.coalesce("chosen", "first_id").alias("id"), "iata")
    return coded.join(keep, ["iata", "id"], "left_semi").select(*airlines.columns)


# ---- airports, routes, runways -----------------------------------------------

def dim_airports(own: DataFrame, other: DataFrame) -> DataFrame:
    """Airports with any code, with city, zone and offset from the second source."""
    second = other.select(
        F.coalesce("iata_code", "icao_code").alias("code_key"),
        F.col("city").alias("other_city"), "timezone", "gmt_offset",
    )
    return (
        own.filter(F.col("icao_code").isNotNull() | F.col("iata_code").isNotNull())
        .withColumn("code_key", F.coalesce("iata_code", "icao_code"))
        .join(null_markers(second), "code_key", "left")
        .select(
            "id", "ident", F.col("type").alias("airport_type"), F.col("name").alias("airport_name"),
            "latitude_deg", "longitude_deg", "iso_country", "continent", "iso_region", "icao_code",
            "iata_code", "gps_code", "local_code", F.coalesce("other_city", "municipality").alias("city"),
            "timezone", "gmt_offset",
        )
    )


def airport_iata_ids(airports: DataFrame) -> DataFrame:
    return airports.filter(F.col("iata_code").isNotNull()).select("id", "iata_code").distinct()


def dim_routes(routes: DataFrame, airlines: DataFrame, airports: DataFrame) -> DataFrame:
    """Routes whose airline and both airports are known."""
    clean = null_markers(routes).filter(
        "airline_iata is not null and source_airport_iata is not null and dest_airport_iata is not null"
    )

    def end(name: str) -> DataFrame:
        return airports.select(
            F.col("iata_code").alias(f"{name}_airport_iata"), F.col("id").alias(f"{name}_airport_id")
        )

    carrier = airlines.select(F.col("iata").alias("airline_iata"), F.col("id").alias("airline_id"))
    return (
        clean.select("airline_iata", "source_airport_iata", "dest_airport_iata", "shared", "stops", "equipments")
        .join(carrier, "airline_iata")
        .join(end("source"), "source_airport_iata")
        .join(end("dest"), "dest_airport_iata")
        .select(
            "airline_iata", "airline_id", "source_airport_iata", "source_airport_id",
            "dest_airport_iata", "dest_airport_id", "shared", "stops", "equipments",
        )
    )


def dim_runways(runways: DataFrame, airports: DataFrame) -> DataFrame:
    return runways.join(airports.select(F.col("id").alias("airport_ref")), "airport_ref", "left_semi").select(
        *runways.columns
    )


# ---- sets and snapshots ------------------------------------------------------

def first_seen(pulls: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First copy of each flight over repeated pulls."""
    from .merge import first_per_key

    return first_per_key(pulls, keys, order)


def snapshot_digest(df: DataFrame) -> DataFrame:
    """One row that does not depend on row order: row count, and xor and sum of row hashes.

    The hash is the start of an MD5 over the values as text, which other engines can repeat.
    """
    values = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in df.columns]
    hashed = F.conv(F.substring(F.md5(F.concat_ws("|", *values)), 1, 15), 16, 10).cast("long")
    return df.select(hashed.alias("h")).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("h").alias("digest"), F.expr("sum(h % 1000003)").alias("sum"),
    )


def snapshot_delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows added and removed between two copies of a file; empty if nothing changed.

    Counts per distinct row and side, so equal rows cancel before any is emitted.
    """
    columns = new.columns
    counted = (
        new.select(*columns, F.lit(1).alias("d")).unionByName(old.select(*columns, F.lit(-1).alias("d")))
        .groupBy(*columns).agg(F.sum("d").alias("d")).filter("d <> 0")
    )
    return counted.select(
        *columns,
        F.when(F.col("d") > 0, "added").otherwise("removed").alias("change"),
        F.abs("d").alias("copies"),
    )
