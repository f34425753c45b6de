"""Five-character geohash as a column expression.

A geohash of five characters has 13 longitude and 12 latitude bits, alternating from longitude, and both axes are
cut in cells of 45/1024 degrees. A character therefore holds three bits of one axis and two of the other: the first,
third and fifth start with longitude, the second and fourth with latitude. Both kinds index the same 32-entry table,
the alphabet laid out by (three bits of the leading axis, two bits of the other).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the public geohash alphabet.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"

LNG_LIMIT, LNG_CELLS = 180, 1 << 13
LAT_LIMIT, LAT_CELLS = 90, 1 << 12


def _interleaved(lead: int, other: int) -> int:
    l2, l1, l0 = lead >> 2, (lead >> 1) & 1, lead & 1
    o1, o0 = other >> 1, other & 1
    return l2 << 4 | o1 << 3 | l1 << 2 | o0 << 1 | l0


TABLE = "".join(ALPHABET[_interleaved(lead, other)] for lead in range(8) for other in range(4))


def _cell(degrees: str, limit: int, cells: int) -> str:
    """Index of the cell holding ``degrees``.

    In units of 1/1024 degree a cell is 45 long and its edges are whole numbers. ``degrees * 1024`` is exact in
    doubles, so the floor and the integer division after it are exact too; dividing doubles would round some values
    just below an edge up to it. The axis' upper end belongs to the last cell.
    """
    return f"int(least((floor({degrees} * 1024D) + {limit * 1024}) div 45, {cells - 1}))"


def _bits(cell: str, low: int, width: int) -> str:
    return f"(shiftright({cell}, {low}) & {(1 << width) - 1})"


def _character(lead: str, lead_low: int, other: str, other_low: int) -> str:
    return f"substr('{TABLE}', {_bits(lead, lead_low, 3)} * 4 + {_bits(other, other_low, 2)} + 1, 1)"


def _letters(x: str, y: str) -> str:
    letters = [_character(x, 10, y, 10), _character(y, 7, x, 8), _character(x, 5, y, 5), _character(y, 2, x, 3),
               _character(x, 0, y, 0)]
    return f"concat({', '.join(letters)})"


def _lng_cell(lng: str) -> str:
    return _cell(lng, LNG_LIMIT, LNG_CELLS)


def _lat_cell(lat: str) -> str:
    return _cell(lat, LAT_LIMIT, LAT_CELLS)


def _on_globe(lat: str, lng: str) -> str:
    return f"{lat} BETWEEN -90 AND 90 AND {lng} BETWEEN -180 AND 180"


def geohash5_sql(lat: str, lng: str) -> str:
    """SQL text of the geohash of two DOUBLE expressions.

    Text, because one parsed expression costs the driver far less than some hundred column calls.
    """
    return f"if({_on_globe(lat, lng)}, {_letters(_lng_cell(lng), _lat_cell(lat))}, NULL)"


def geohash5(lat: str = "lat", lng: str = "lng") -> Column:
    """Geohash text of two coordinate columns; NULL when one is NULL, NaN or off the globe."""
    return F.expr(geohash5_sql(lat, lng))


def with_geohash(rows: DataFrame, out: str, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Add the geohash of two coordinate columns.

    The cell numbers are columns of their own first: each letter uses both, and as columns they are computed once and
    keep the generated code a fifth of its size.
    """
    cells = rows.selectExpr("*", f"if({_on_globe(lat, lng)}, {_lng_cell(lng)}, NULL) AS __x",
                            f"{_lat_cell(lat)} AS __y")
    return cells.selectExpr("*", f"{_letters('__x', '__y')} AS {out}").drop("__x", "__y")
