"""The library's names and weather rules as SQL functions, and board pages as a table function.

``register`` makes them known to a session; they are then used in any SQL text:

    select trigram_similarity(a, b), decode_weather(wx), weather_severity(wx) from ...
    select b.* from pages p, lateral board_rows(p.path, p.html) b
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from ..session import ship_package
from ..sources.boards import page_rows
from . import weather

BOARD_ROWS = "path string, place int, departure string, arrival string, status string, error string"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _statements() -> list[str]:
    pairs = "|".join(code for code in weather.WX_WORDS if len(code) == 2)
    words = ", ".join(f"{_quoted(code)}, {_quoted(word)}" for code, word in weather.WX_WORDS.items())
    marks = " ".join(f"when left(trim(wx), 1) = {_quoted(m)} then {_quoted(w)}" for m, w in weather.INTENSITY.items())
    signs = ", ".join(map(_quoted, weather.INTENSITY))
    classes = " ".join(
        "when " + " or ".join(f"contains(wx, {_quoted(c)})" for c in codes) + f" then {_quoted(name)}" for name, codes in weather.SEVERITY
    )
    codes = (
        rf"regexp_extract_all(if(left(trim(wx), 1) in ({signs}), substr(trim(wx), 2), trim(wx)), '({pairs}|[+\\-]\\z)', 1)"
    )
    return [
        r"""trigrams(name string) returns array<string> return array_distinct(flatten(transform(
            filter(split(lower(name), '[^\\p{L}\\p{N}]+'), w -> w <> ''),
            w -> transform(sequence(1, length(w) + 1), i -> substr(concat('  ', w, ' '), i, 3)))))""",
        """trigram_similarity(a string, b string) returns double return
            case when size(array_union(trigrams(a), trigrams(b))) > 0
                then size(array_intersect(trigrams(a), trigrams(b))) / size(array_union(trigrams(a), trigrams(b))) else 0.0 end""",
        f"""decode_weather(wx string) returns string return
            case when wx is null or wx in ('', 'CLEAR') then {_quoted(weather.CLEAR_SKY)}
                when size({codes}) > 0 then concat(case {marks} else '' end,
                    concat_ws(' + ', transform({codes}, c -> map({words})[c]))) else wx end""",
        f"""weather_severity(wx string) returns string return
            case when wx is null or wx in ('', 'CLEAR') then 'clear' {classes} else 'other' end""",
    ]


@udtf(returnType=BOARD_ROWS, useArrow=False)
class BoardRows:
    """Rows of one board page; a page that cannot be read is one row with ``error``.

    Spark takes no Arrow table function beside a lateral row, so this one has none; ``boards.parsed_pages`` is the batched form.
    """

    def eval(self, path: str, html: str) -> Iterator[tuple]:
        try:
            found = page_rows(path, html)
        except (AssertionError, ValueError) as error:
            found = [{"error": f"{type(error).__name__}: {error}"}]
        for place, row in enumerate(found):
            departure, arrival = ((row.get(end) or {}).get("text") for end in ("departure", "arrival"))
            yield path, place, departure, arrival, row.get("status"), row.get("error")


def register(spark: SparkSession) -> list[str]:
    """Register the functions with a session; their names."""
    ship_package(spark)
    statements = _statements()
    for statement in statements:
        spark.sql(f"create or replace temporary function {statement}")
    spark.udtf.register("board_rows", BoardRows)
    return [s.split("(")[0] for s in statements] + ["board_rows"]
