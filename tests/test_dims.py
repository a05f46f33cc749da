from difflib import SequenceMatcher

from conftest import rows

from pyspark.sql import functions as F

from aeroledger.functions import text
from aeroledger.operators import dims, quality


def grams(name):
    import re

    out = set()
    for word in re.split(r"[^\w]+", name.lower()):
        if word:
            padded = f"  {word} "
            out |= {padded[i:i + 3] for i in range(len(padded) - 2)}
    return out


def names(spark, values, column):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def test_similarity_value(spark):
    got = text.similar_names(names(spark, ["word"], "a"), "a", names(spark, ["two words"], "b"), "b").first()
    assert round(got["score"], 4) == 0.3636


def test_similar_names_against_brute_force(spark):
    left = ["France", "Côte d'Ivoire", "Korea, South", "Korea, North", "United States", "A", "Niger", "Guinea", "", "Saint Lucia"]
    right = ["france", "Ivory Coast", "South Korea", "North Korea", "United States of America", "a", "Nigeria", "Equatorial Guinea",
             "Guinea-Bissau", "!!", "St Lucia", "United Kingdom"]
    got = {(r["a"], r["b"]): r["score"] for r in text.similar_names(names(spark, left, "a"), "a", names(spark, right, "b"), "b").collect()}
    want = {}
    for a in left:
        for b in right:
            x, y = grams(a), grams(b)
            if x | y and len(x & y) / len(x | y) > 0.3:
                want[a, b] = len(x & y) / len(x | y)
    assert got == want and len(want) > 8


def test_countries(spark):
    countries = spark.createDataFrame(
        [(1, "KR", "South Korea"), (2, "KP", "North Korea"), (3, "FR", "France"), (4, "ZZ", "Atlantis")],
        "id long, code string, name string",
    )
    fleet = spark.createDataFrame([("Korea, South", 9.0), ("France", 10.0), ("Koreas", 3.0)], "country_name string, average_age double")
    got = {r["code"]: (r["country_name"], r["average_age"]) for r in dims.dim_countries(countries, fleet).collect()}
    assert got["KR"] == ("Korea, South", 9.0) and got["FR"] == ("France", 10.0) and got["ZZ"] == ("Atlantis", None)
    assert len(got) == 4


AIRLINE = "id long, name string, iata string, icao string, active string"


def test_active_flag(spark):
    source = spark.createDataFrame([(1, "N"), (2, "y"), (3, None), (4, "y"), (5, "x"), (6, "N")], "id long, active string")
    assert rows(dims.active_flag(source, None)) == [(1, "N"), (2, "Y"), (3, "N"), (4, "Y"), (5, "N"), (6, "N")]
    stored = spark.createDataFrame([(1, "Y"), (2, "N"), (3, "Y"), (5, "Y")], "id long, active string")
    assert rows(dims.active_flag(source, stored)) == [(1, "N"), (2, "Y"), (3, "Y"), (4, "Y"), (5, "Y"), (6, "N")]


def test_authority(spark):
    airlines = spark.createDataFrame([
        (1, "Alpha", "AA", "XXX", "Y"), (2, "Beta", "AA", "BBB", "Y"), (3, "Gamma", "AA", "CCC", "N"),
        (4, "Delta Air", "DD", None, "Y"), (5, "Delta Airlines", "DD", None, "Y"),
        (6, "One", "EE", None, "Y"), (7, "Two", "EE", None, "Y"), (8, "Solo", "SS", None, "N"), (9, "Blank", "", None, "Y"),
    ], AIRLINE)
    authority = spark.createDataFrame(
        [("AA", "bbb", "other"), ("AA", "", "GAMMA"), ("DD", "", "Delta Air Lines")], "iata string, icao string, name string"
    )
    assert rows(dims.active_duplicates(airlines)) == [("AA", 2), ("DD", 2), ("EE", 2)]
    best = max([(SequenceMatcher(None, n.lower(), "delta air lines").ratio(), i) for i, n in ((4, "Delta Air"), (5, "Delta Airlines"))])[1]
    contested = airlines.filter("upper(active) = 'Y'")
    assert rows(dims.authority_match(contested, authority), "iata", "id") == [("AA", 2), ("DD", best)]
    cleared = dims.clear_active_duplicates(airlines, authority)
    assert rows(cleared.filter("active = 'Y'"), "id") == [(2,), (best,), (9,)]
    assert rows(dims.one_row_per_iata(airlines, authority), "id") == sorted([(2,), (best,), (6,), (8,)])


def test_routes_and_markers(spark):
    routes = spark.createDataFrame([
        ("AF", "CDG", "JFK", "\\N", "0", "777"), ("\\N", "CDG", "JFK", "Y", "0", "777"), ("AF", "CDG", "XXX", "Y", "0", "\\N"),
    ], "airline_iata string, source_airport_iata string, dest_airport_iata string, shared string, stops string, equipments string")
    airlines = spark.createDataFrame([(137, "AF")], "id long, iata string")
    airports = spark.createDataFrame([(1, "CDG"), (2, "JFK")], "id long, iata_code string")
    assert rows(dims.dim_routes(routes, airlines, airports)) == [("AF", 137, "CDG", 1, "JFK", 2, None, "0", "777")]


def test_snapshots(spark):
    old = spark.createDataFrame([("a",), ("a",), ("b",)], "x string")
    new = spark.createDataFrame([("a",), ("c",), ("c",)], "x string")
    assert rows(dims.snapshot_delta(old, new)) == [("a", "removed", 1), ("b", "removed", 1), ("c", "added", 2)]
    assert dims.snapshot_delta(old, old.repartition(3)).count() == 0
    assert dims.snapshot_digest(old).first() == dims.snapshot_digest(old.repartition(3)).first()
    assert dims.snapshot_digest(old).first() != dims.snapshot_digest(new).first()


def test_quality(spark):
    df = spark.createDataFrame([(1, "Y"), (1, "N"), (2, "Q"), (None, None), (None, "Y")], "id long, flag string")
    parent = spark.createDataFrame([(1,)], "pid long")
    checks = [
        quality.Check("unique", "t", "unique", ("id",)), quality.Check("null", "t", "not_null", ("id",)),
        quality.Check("rel", "t", "relationship", ("id",), parent=("p", "pid")),
        quality.Check("values", "t", "accepted", ("flag",), values=("Y", "N")),
        quality.Check("none", "t", "condition", condition="id > 5"), quality.Check("pairs", "t", "unique", ("id", "flag")),
    ]
    counts = quality.report({"t": df, "p": parent}, checks)
    assert rows(counts, "check", "violations") == [
        ("none", 0), ("null", 2), ("pairs", 0), ("rel", 1), ("unique", 1), ("values", 1)
    ]
    assert quality.unique(df, ["id"]).count() == 1 and quality.not_null(df, "id").count() == 2
    assert quality.relationship(df, "id", parent, "pid").count() == quality.accepted_values(df, "flag", ["Y", "N"]).count() == 1
    sky = spark.createDataFrame([(1, 1, None), (2, None, None), (3, 1, 1)], "id long, metar_fk long, taf_fk long")
    assert rows(quality.one_parent(sky), "id") == [(2,), (3,)]


def test_hot_trigrams_are_split(spark, monkeypatch):
    monkeypatch.setattr(text, "HOT_GRAM", 5)
    left = [f"air {w} {i}" for w in ("alpha", "beta", "gamma") for i in range(30)]
    right = [f"air {w} {i}x" for w in ("alpha", "delta") for i in range(30)]
    got = {(r["a"], r["b"]) for r in text.similar_names(names(spark, left, "a"), "a", names(spark, right, "b"), "b").collect()}
    want = {(a, b) for a in left for b in right if len(grams(a) & grams(b)) / len(grams(a) | grams(b)) > 0.3}
    assert got == want and len(want) > 900


def test_rows_without_a_key_are_dealt_out(spark):
    from aeroledger.operators.joins import left_join_spread

    left = spark.range(1000).select(F.col("id").alias("f"), F.when(F.col("id") % 3 == 0, F.col("id") % 7).alias("k"))
    right = spark.createDataFrame([(i, f"r{i}") for i in range(6)] + [(None, "never")], "k long, v string")
    joined = left_join_spread(left, right, "k", F.col("f"))
    want = left.join(right, "k", "left").select("f", "k", "v")
    assert rows(joined, "f", "k", "v") == rows(want, "f", "k", "v")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in plan
    named = left.withColumn("k", F.concat(F.lit("s"), "k"))
    text_right = right.withColumn("k", F.concat(F.lit("s"), "k"))
    assert rows(left_join_spread(named, text_right, "k", F.col("f")), "f", "v") == rows(want, "f", "v")


def test_estimated_size(spark):
    from aeroledger.operators import sizing

    side = spark.createDataFrame([("x" * 1000, [1, 2]), (None, None)], "a string, b array<int>")
    assert 1000 < sizing.estimated_bytes(side) < 1400
    assert sizing.estimated_bytes(side.limit(0)) == 0
