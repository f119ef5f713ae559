"""Latitude-band cells: the equi-join key behind every radius operator.

A band is ``floor(lat / d)``. Each band has its own cell width in longitude, so cells keep about
the same size on the ground at every latitude. A row of the indexed side sits in one cell; a row
of the probing side is copied to every cell its radius touches, at most a few per band. Rows near
the antimeridian also probe the wrapped longitude.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from waymark.functions.geo import degrees_for

_SLACK = 1.000001


def cell_degrees(radius: float, unit: str) -> float:
    """Cell height in degrees so that a radius never reaches past the adjacent band."""
    return degrees_for(radius, unit) * _SLACK


def _width(band: str, d: float) -> str:
    """Longitude width of cells in a band, from the band edge farthest from the equator."""
    return f"({d!r}D / cos(radians(least(greatest(abs({band} * {d!r}D), abs(({band} + 1) * {d!r}D)), 89D))))"


def with_cell(df: DataFrame, lat: str, lon: str, d: float, prefix: str = "cell") -> DataFrame:
    """Add ``<prefix>_b`` and ``<prefix>_l``: the one cell of each row."""
    band = f"floor({lat} / {d!r}D)"
    return df.selectExpr("*", f"{band} as {prefix}_b", f"floor({lon} / {_width(band, d)}) as {prefix}_l")


def with_probe_cells(
    df: DataFrame, lat: str, lon: str, radius: float, unit: str, d: float, prefix: str = "cell"
) -> DataFrame:
    """Copy each row to every cell within ``radius``; adds ``<prefix>_b`` and ``<prefix>_l``."""
    r = degrees_for(radius, unit) * _SLACK
    # widest longitude difference a point within the radius can have
    ratio = f"(sin(radians({r!r}D)) / cos(radians({lat})))"
    spread = df.selectExpr(
        "*", f"case when {ratio} < 1 then degrees(asin({ratio})) * {_SLACK!r}D else 180D end as _rho"
    )

    def span(shift: str) -> str:
        w = _width("t", d)
        return f"sequence(floor(({lon} - _rho {shift}) / {w}), floor(({lon} + _rho {shift}) / {w}))"

    cells = (
        f"case when {lon} + _rho > 180 then array_union({span('')}, {span('- 360')}) "
        f"when {lon} - _rho < -180 then array_union({span('')}, {span('+ 360')}) else {span('')} end"
    )
    probe = (
        f"explode(flatten(transform(sequence(floor(({lat} - {r!r}D) / {d!r}D), floor(({lat} + {r!r}D) / {d!r}D)), "
        f"t -> transform({cells}, c -> struct(t as b, c as l))))) as _probe"
    )
    kept = [f"`{c}`" for c in df.columns]
    return spread.selectExpr(*kept, probe).selectExpr(*kept, f"_probe.b as {prefix}_b", f"_probe.l as {prefix}_l")
