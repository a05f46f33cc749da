"""DuckDB statements that state each query's result independently."""


def statements() -> dict[str, str]:
    from . import associate, days, io, merge, model, models, normalize, reports, state, streaming

    return {**reports.SQL, **associate.SQL, **merge.SQL, **normalize.SQL, **model.SQL, **streaming.SQL, **io.SQL, **days.SQL, **state.SQL, **models.SQL}
