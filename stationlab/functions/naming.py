"""Station and metric names encoded in wide column names (``<STATION>_<metric>``)."""

from __future__ import annotations

from collections.abc import Iterable

# The metric suffixes of the wide station table.
METRIC_SUFFIXES = ("temp_mean", "temp_min", "temp_max", "humidity", "pressure", "precipitation", "wind_speed")


def split_name(column: str, suffixes: Iterable[str] = METRIC_SUFFIXES) -> tuple[str, str] | None:
    """``DE_BILT_temp_mean`` -> ``("DE_BILT", "temp_mean")``; None when no suffix fits.

    The longest suffix wins, so station names may hold underscores.
    """
    best = None
    for s in suffixes:
        if column.endswith("_" + s) and len(column) > len(s) + 1 and (best is None or len(s) > len(best)):
            best = s
    return None if best is None else (column[: -len(best) - 1], best)


def station_columns(columns: Iterable[str], suffixes: Iterable[str] = METRIC_SUFFIXES) -> dict[str, tuple[str, str]]:
    """Column name -> (station, metric) for every station column."""
    suffixes = tuple(suffixes)
    found = {c: split_name(c, suffixes) for c in columns}
    return {c: v for c, v in found.items() if v is not None}


def stations(columns: Iterable[str]) -> list[str]:
    return sorted({s for s, _ in station_columns(columns).values()})
