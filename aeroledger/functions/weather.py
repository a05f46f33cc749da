"""Weather code strings: readable text, severity and delay impact."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weather codes and their wording.
WX_WORDS = {
    "MI": "Mince (shallow)",
    "BC": "Bancs (patches)",
    "PR": "Partiel (partial)",
    "DR": "Chasse basse (low drifting)",
    "BL": "Chasse elevee (blowing)",
    "SH": "Averses (showers)",
    "TS": "Orage (thunderstorm)",
    "FZ": "Givrant (freezing)",
    "RE": "Recent",
    "VC": "Au voisinage (vicinity)",
    "RA": "Pluie (rain)",
    "DZ": "Bruine (drizzle)",
    "SN": "Neige (snow)",
    "SG": "Neige en grains (snow grains)",
    "IC": "Cristaux de glace (ice crystals)",
    "PL": "Granules de glace (ice pellets)",
    "GR": "Grele (hail >= 5mm)",
    "GS": "Gresil (small hail < 5mm)",
    "UP": "Precipitation inconnue (unknown)",
    "FG": "Brouillard (fog, vis < 1 km)",
    "BR": "Brume (mist, 1-5 km vis)",
    "HZ": "Brume seche (haze)",
    "FU": "Fumee (smoke)",
    "VA": "Cendres volcaniques (volcanic ash)",
    "DU": "Poussiere etendue (dust)",
    "SA": "Sable (sand)",
    "PY": "Embruns (spray)",
    "SQ": "Grain (squall)",
    "PO": "Tourbillons de sable/poussiere",
    "DS": "Tempete de sable (dust storm)",
    "SS": "Tempete de sable (sandstorm)",
    "FC": "Trombe/tornade (funnel cloud)",
    "+": "Fort (heavy)",
    "-": "Faible (light)",
}
CLEAR_SKY = "Ciel degage / Pas de phenomene"
INTENSITY = {"+": "Fort ", "-": "Faible "}

# Severity classes, first match wins.
SEVERITY = [
    ("storm", ["TS", "+", "FZ"]),
    ("snow", ["SN", "GR", "PL", "IC"]),
    ("rain", ["RA", "DZ", "SH"]),
    ("fog", ["FG", "BR", "HZ", "FU"]),
]


def _has(text: Column, *codes: str) -> Column:
    found = text.contains(codes[0])
    for code in codes[1:]:
        found = found | text.contains(code)
    return found


def decode_wx(wx: Column) -> Column:
    """Readable weather: intensity, then each known two-letter code in order.

    Unknown characters are skipped one by one, which is how a regular expression
    scans. A lone sign is a code only as the last character. Text without any
    known code is returned as it is.
    """
    trimmed = F.trim(wx)
    sign = F.substring(trimmed, 1, 1)
    signed = sign.isin(list(INTENSITY))
    body = F.when(signed, F.substring(trimmed, 2, 1_000_000)).otherwise(trimmed)
    pairs = "|".join(code for code in WX_WORDS if len(code) == 2)
    codes = F.regexp_extract_all(body, F.lit(rf"({pairs}|[+\-]\z)"), F.lit(1))
    words = F.create_map(*[F.lit(x) for x in chain.from_iterable(WX_WORDS.items())])
    prefix = F.lit("")
    for mark, word in INTENSITY.items():
        prefix = F.when(sign == mark, word).otherwise(prefix)
    text = F.concat(prefix, F.concat_ws(" + ", F.transform(codes, lambda c: words[c])))
    return (
        F.when(wx.isNull() | wx.isin("", "CLEAR"), CLEAR_SKY)
        .when(F.size(codes) > 0, text)
        .otherwise(wx)
    )


def severity_class(wx: Column) -> Column:
    label = F.lit("other")
    for name, codes in reversed(SEVERITY):
        label = F.when(_has(wx, *codes), name).otherwise(label)
    return F.when(wx.isNull() | wx.isin("", "CLEAR"), "clear").otherwise(label)


# Impact levels, weakest first.
IMPACT_ORDER = ["none", "low", "medium", "high"]


# What is looked for in a weather string, any of the codes.
IMPACT_MARKS = {
    "storm": ["TS"], "hail": ["GR"], "squall": ["SQ"], "dust": ["SS", "DS"], "fog": ["FG"], "freezing": ["FZ"],
    "snow": ["SN"], "rain": ["RA"], "heavy": ["HVY", "+"], "drizzle": ["DZ", "BR"], "ice": ["IC", "PE"], "mist": ["BR"],
}


def impact_text(wx: Column) -> Column:
    return F.upper(F.trim(F.when(wx == "nan", F.lit("")).otherwise(F.coalesce(wx, F.lit("")))))


def impact_marks(text: Column) -> dict[str, Column]:
    return {name: _has(text, *codes) for name, codes in IMPACT_MARKS.items()}


def impact_of(marks: dict[str, Column]) -> dict[str, Column]:
    """Impact level, simplified code and four flags from what a weather string holds."""
    storm, hail, squall, dust, fog, freezing, snow, rain, heavy, drizzle, crystals, mist = (marks[name] for name in IMPACT_MARKS)
    ice = freezing & (rain | snow)
    heavy_rain = rain & heavy
    light = rain | drizzle
    level = (
        F.when(storm | hail | squall | dust | fog, "high")
        .when(ice | snow | heavy_rain, "medium")
        .when(light, "low")
        .otherwise("none")
    )
    # A squall without thunder counts as a thunderstorm, but hail and dust go first.
    code = (
        F.when(storm, "THUNDERSTORM").when(hail, "HAIL").when(dust, "DUST_STORM")
        .when(squall, "THUNDERSTORM").when(fog, "FOG").when(ice, "ICING").when(snow, "SNOW")
        .when(heavy_rain, "RAIN").when(light, "LIGHT_WEATHER").otherwise("CLEAR")
    )
    return {
        "weather_impact": level,
        "weather_simplified": code,
        "has_convective": storm | squall | hail,
        "has_icing": freezing | crystals,
        "visibility_affected": fog | mist,
        "wind_affected": storm | squall,
    }


def impact(wx: Column) -> dict[str, Column]:
    """Impact level, simplified code and four flags of one weather string."""
    return impact_of(impact_marks(impact_text(wx)))


def worst_impact(left: Column, right: Column) -> Column:
    levels = F.array(*[F.lit(level) for level in IMPACT_ORDER])
    return F.element_at(levels, F.greatest(F.array_position(levels, left), F.array_position(levels, right)).cast("int"))
