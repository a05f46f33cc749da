"""Cleaning of feed text into typed values; anything unusable becomes null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Accepted shapes of a timestamp once Z and fraction are removed.
TIMESTAMP_SHAPES = [
    r"\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}",
    r"\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}",
    r"\d{8}_\d{6}",
    r"\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}",
]


def clean_timestamp(text: Column | str) -> Column:
    """Timestamp without zone (UTC by convention), or null for any other shape."""
    bare = F.split(F.replace(_col(text), F.lit("Z"), F.lit("")), r"\.", 2)[0]
    spaced = F.regexp_replace(bare, r"^(\d{4})(\d\d)(\d\d)_(\d\d)(\d\d)(\d\d)$", "$1-$2-$3 $4:$5:$6")
    fits = bare.rlike("^(" + "|".join(TIMESTAMP_SHAPES) + ")$")
    return F.when(fits, spaced.try_cast("timestamp_ntz"))


def clean_decimal(text: Column | str, places: int = 2, precision: int = 5) -> Column:
    """Digits, point and sign kept; rounded half to even to ``places``."""
    kept = F.regexp_replace(_col(text), r"[^0-9.\-]", "")
    number = F.when(~kept.isin("", "-"), kept).try_cast("decimal(38,18)")
    return F.bround(number, places).try_cast(f"decimal({precision},{places})")


def clean_integer(text: Column | str, kind: str = "int") -> Column:
    """Digits and sign kept, so a decimal point is dropped: 10.5 becomes 105."""
    kept = F.regexp_replace(_col(text), r"[^0-9\-]", "")
    return F.when(~kept.isin("", "-"), kept).try_cast(kind)


def lost_decimal_point(text: Column | str) -> Column:
    """True where ``clean_integer`` changed the magnitude of a decimal number."""
    return F.coalesce(_col(text).rlike(r"\d\.\d"), F.lit(False))


# Name parts of numeric feed columns, and texts never converted.
NUMERIC_NAME_PARTS = [
    "latitude", "longitude", "elevation_m", "temp_c", "dewpoint_c", "wind_dir_degrees", "wind_speed_kt",
    "wind_gust_kt", "visibility_statute_mi", "altim_in_hg", "cloud_base_ft_agl", "max_temp_c", "min_temp_c",
]
KEPT_TEXTS = ["VRB", "NSC", "6+", "CAVOK"]


def with_numbers(df: DataFrame, suffix: str = "_num") -> DataFrame:
    """Add a number beside each numeric-named text column; the text stays."""
    named = [
        c for c, t in df.dtypes if t == "string" and any(part in c.lower() for part in NUMERIC_NAME_PARTS)
    ]
    return df.withColumns({
        c + suffix: F.when(~F.col(c).isin(KEPT_TEXTS), F.col(c)).try_cast("double") for c in named
    })


def flatten(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Nested structs as flat columns joined by ``_``; arrays are kept whole."""
    from pyspark.sql import types as T

    out: list[Column] = []

    def walk(fields, path: list[str], prefix: str) -> None:
        for field in fields:
            if field.name in exclude:
                continue
            here, name = [*path, field.name], prefix + field.name
            if isinstance(field.dataType, T.StructType):
                walk(field.dataType.fields, here, name + "_")
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(name))

    walk(df.schema.fields, [], "")
    return df.select(*out)


def split_valid(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required values, and the rest for quarantine."""
    filled = F.lit(True)
    for name in required:
        filled = filled & (F.coalesce(F.col(name), F.lit("")) != "")
    return df.filter(filled), df.filter(~filled)
