"""Property filters: from plain Python values to Catalyst predicates.

A filter is an operator and a value bound to a property name.  Filters are turned into ``Column`` expressions, never into
SQL text, so quoting and escaping are Spark's business and every comparison on a flat column reaches the Parquet scan.
"""

from __future__ import annotations

import datetime as dt
import math
import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class PropertyFilter(NamedTuple):
    """One comparison: ``op`` is one of the six operators, ``value`` a literal."""

    op: str
    value: Any


def EQ(value: Any) -> PropertyFilter:
    return PropertyFilter("=", value)


def NEQ(value: Any) -> PropertyFilter:
    return PropertyFilter("!=", value)


def GT(value: Any) -> PropertyFilter:
    return PropertyFilter(">", value)


def GTE(value: Any) -> PropertyFilter:
    return PropertyFilter(">=", value)


def LT(value: Any) -> PropertyFilter:
    return PropertyFilter("<", value)


def LTE(value: Any) -> PropertyFilter:
    return PropertyFilter("<=", value)


_COMPARE = {
    "=": lambda a, b: a == b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<>": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}

# The platforms that fly for each mission.
MISSION_PLATFORMS = {
    "sentinel1": ("S1A", "S1B"),
    "sentinel2": ("S2A", "S2B"),
    "landsatoli": ("L8", "L9"),
}

# The period a search covers when no dates are given.
DEFAULT_START = "2000-01-01"
DEFAULT_END = "2025-12-31"


def property_column(name: str) -> Column:
    """Column of a property whose name may hold ``:``, blanks or back-quotes."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_of(predicates: Iterable[Column]) -> Column:
    """AND of the predicates; TRUE when there are none."""
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def any_of(predicates: Iterable[Column]) -> Column:
    """OR of the predicates; FALSE when there are none."""
    return reduce(lambda a, b: a | b, predicates, F.lit(False))


def filter_expressions(filters: Mapping[str, PropertyFilter]) -> list[dict]:
    """CQL2-JSON comparison for each entry, in the order of the mapping."""
    out = []
    for name, flt in filters.items():
        if not isinstance(flt, PropertyFilter):
            raise TypeError(f"{name!r} needs a PropertyFilter, not a {type(flt).__name__}")
        out.append({"op": flt.op, "args": [{"property": name}, flt.value]})
    return out


def conjunction(expressions: Sequence[dict]) -> dict | None:
    """One CQL2-JSON object for a list: nothing for none, itself for one, an ``and`` for more."""
    if len(expressions) > 1:
        return {"op": "and", "args": list(expressions)}
    return expressions[0] if expressions else None


def expression_column(expression: dict | None) -> Column:
    """Predicate of a CQL2-JSON object (six comparisons and nested ``and``)."""
    if expression is None:
        return F.lit(True)
    op, args = expression["op"], expression["args"]
    if op == "and":
        return all_of(expression_column(a) for a in args)
    if op not in _COMPARE:
        raise ValueError(f"unknown operator {op!r}")

    def operand(arg: Any) -> Column:
        if isinstance(arg, dict) and "property" in arg:
            return property_column(arg["property"])
        return F.lit(arg)

    return _COMPARE[op](*(operand(a) for a in args))


def predicate(filters: Mapping[str, PropertyFilter]) -> Column:
    """All filters of the mapping as one predicate."""
    return expression_column(conjunction(filter_expressions(filters)))


def default_filters(epsg_code: str | int, percent_valid_pixels: float = 1.0) -> dict[str, PropertyFilter]:
    """The two usual filters: share of valid pixels and projection."""
    return {
        "percent_valid_pixels": GTE(percent_valid_pixels),
        "proj:code": EQ(f"EPSG:{epsg_code}"),
    }


def mission_predicate(mission: str, column: str = "platform") -> Column:
    """Rows of one mission, whatever the case of its name; an unknown mission is an error."""
    platforms = MISSION_PLATFORMS.get(mission.lower())
    if platforms is None:
        raise ValueError(f"unknown mission {mission!r}; known: {sorted(MISSION_PLATFORMS)}")
    return F.col(column).isin(*platforms)


def interval_predicate(min_interval: float | None, max_interval: float | None, column: str = "date_dt") -> Column:
    """Pair separation within the bounds given; both, one or none."""
    parts = []
    if min_interval is not None:
        parts.append(F.col(column) >= min_interval)
    if max_interval is not None:
        parts.append(F.col(column) <= max_interval)
    return all_of(parts)


def as_date(value: str | dt.date | None, default: str) -> dt.date:
    if value is None:
        value = default
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return check_date(value)


def time_predicate(
    start: str | dt.date | None = None, end: str | dt.date | None = None, column: str = "datetime"
) -> Column:
    """Whole days from ``start`` to ``end``, both included."""
    first = as_date(start, DEFAULT_START)
    after = as_date(end, DEFAULT_END) + dt.timedelta(days=1)
    # NTZ literals compare with both timestamp types; on NTZ columns no cast stands between column and scan.
    t = F.col(column)
    return (t >= F.expr(f"TIMESTAMP_NTZ '{first} 00:00:00'")) & (t < F.expr(f"TIMESTAMP_NTZ '{after} 00:00:00'"))


def granule_predicate(
    percent_valid_pixels: float = 1,
    mission: str | None = None,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    min_interval: float | None = None,
    max_interval: float | None = None,
    filters: Mapping[str, PropertyFilter | None] | None = None,
    collection: str | None = None,
    time_filter: bool = True,
) -> Column:
    """Every non-spatial condition of a granule search.

    Caller filters win over the condition a parameter would set on the same property; entries that are None are skipped.
    """
    given = dict(filters or {})
    own = []
    if percent_valid_pixels > 0 and "percent_valid_pixels" not in given:
        own.append(F.col("percent_valid_pixels") >= percent_valid_pixels)
    if mission and "platform" not in given:
        own.append(mission_predicate(mission))
    one_sided = (min_interval is None) != (max_interval is None)
    # As with the other parameters, a caller's own date_dt filter replaces a one-sided bound; a two-sided range stays.
    if not (one_sided and "date_dt" in given):
        own.append(interval_predicate(min_interval, max_interval))
    if collection is not None:
        own.append(F.col("collection") == collection)
    if time_filter:
        own.append(time_predicate(start, end))
    own.append(predicate({k: v for k, v in given.items() if v is not None}))
    return all_of(own)


# ---- filter text -------------------------------------------------------------------------------------------------

# Operators of the filter text, longest first.
TEXT_OPERATORS = (">=", "<=", "!=", "=", ">", "<")
_OPERATOR_TOKEN = re.compile(":(" + "|".join(TEXT_OPERATORS) + "):")
_COLUMN_PATTERN = "(?s)^(.*?):(" + "|".join(TEXT_OPERATORS) + "):(.*)$"


def literal_of(text: str) -> int | float | str:
    """Canonical integer, else number, else text; zero-padded digits such as ``002`` stay text."""
    try:
        number = int(text)
    except ValueError:
        try:
            return float(text)
        except ValueError:
            return text
    return number if str(number) == text else text


def parse_filter(text: str) -> tuple[str, PropertyFilter]:
    """``property:operator:value``; the first operator token splits, so names and values may hold colons."""
    pieces = _OPERATOR_TOKEN.split(text, maxsplit=1)
    if len(pieces) != 3:
        raise ValueError(f"{text!r} is not of the form property:operator:value with one of {TEXT_OPERATORS}")
    name, op, value = pieces
    return name, PropertyFilter(op, literal_of(value))


def parse_filters(texts: Iterable[str]) -> dict[str, PropertyFilter]:
    """Mapping of all filter texts; on a repeated property the last one stays."""
    return dict(parse_filter(t) for t in texts)


def parse_filter_column(text: Column) -> Column:
    """The same split over a column of filter texts, as ``struct(property, op, value, value_kind)``; NULL if malformed."""
    name, op, value = (F.regexp_extract(text, _COLUMN_PATTERN, i) for i in (1, 2, 3))
    kind = (
        F.when(value.rlike(r"^(0|-?[1-9][0-9]*)$"), "int")
        .when(value.rlike(r"^[+-]?[0-9]+$"), "text")
        .when(value.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), "float")
        .otherwise("text")
    )
    parsed = F.struct(name.alias("property"), op.alias("op"), value.alias("value"), kind.alias("value_kind"))
    return F.when(text.rlike(_COLUMN_PATTERN), parsed)


# ---- checks of user input ----------------------------------------------------------------------------------------


def _numbers(value: str | Sequence[float], what: str) -> list[float]:
    try:
        parts = value.split(",") if isinstance(value, str) else value
        return [float(p) for p in parts]
    except (TypeError, ValueError) as err:
        raise ValueError(f"{what}: not a list of numbers: {value!r}") from err


def check_longitude(lon: float) -> float:
    if not -180 <= lon <= 180:
        raise ValueError(f"longitude {lon} is outside -180..180")
    return lon


def check_latitude(lat: float) -> float:
    if not -90 <= lat <= 90:
        raise ValueError(f"latitude {lat} is outside -90..90")
    return lat


def check_bbox(value: str | Sequence[float]) -> list[float]:
    """Four numbers ``min_lon,min_lat,max_lon,max_lat`` within the globe."""
    box = _numbers(value, "bbox")
    if len(box) != 4:
        raise ValueError("bbox: four numbers wanted: min_lon,min_lat,max_lon,max_lat")
    for lon, lat in (box[:2], box[2:]):
        check_longitude(lon)
        check_latitude(lat)
    return box


def check_polygon(value: str | Sequence[float]) -> list[float]:
    """At least three lon,lat pairs in one flat list."""
    flat = _numbers(value, "polygon")
    if len(flat) < 6 or len(flat) % 2:
        raise ValueError("polygon: an even count of at least six numbers wanted: lon,lat,lon,lat,…")
    if not all(math.isfinite(v) for v in flat):
        raise ValueError("polygon: numbers must be finite")
    return flat


def check_date(value: str) -> dt.date:
    try:
        return dt.datetime.strptime(value, "%Y-%m-%d").date()
    except ValueError as err:
        raise ValueError(f"{value!r} is not a date in YYYY-MM-DD form") from err


def lonlat_reject_reason(lon: Column, lat: Column) -> Column:
    """NULL for a usable position, else why it is not."""
    return (
        F.when(lon.isNull() | F.isnan(lon), "lon_not_a_number")
        .when(lat.isNull() | F.isnan(lat), "lat_not_a_number")
        .when(~lon.between(-180, 180), "lon_out_of_range")
        .when(~lat.between(-90, 90), "lat_out_of_range")
    )


def bbox_reject_reason(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """NULL for a usable box over a table of boxes, else the first failing bound."""
    return F.coalesce(lonlat_reject_reason(minx, miny), lonlat_reject_reason(maxx, maxy))


def date_column(text: Column) -> Column:
    """``YYYY-MM-DD`` text as DATE, NULL otherwise."""
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))
