"""firnflow: search and time series of ice velocity on Spark."""

from firnflow.functions.filters import EQ, GT, GTE, LT, LTE, NEQ, PropertyFilter
from firnflow.operators.asof import nearest_on_axes
from firnflow.operators.locate import find_cubes, find_cubes_for, locate, locate_two_step, missing_points
from firnflow.operators.profile import densify
from firnflow.operators.resample import resample
from firnflow.operators.running_mean import running_mean
from firnflow.operators.saved import match_saved
from firnflow.operators.search import coverage, match, search, search_many, stream_hrefs
from firnflow.operators.series import annual_series, time_series
from firnflow.operators.subcube import around_points, in_boxes
from firnflow.sinks.series import export_points, write_clustered, write_series
from firnflow.sources.chunks import dense_chunks, series_from_chunks
from firnflow.sources.zones import search_zoned, write_zones

__all__ = [
    "EQ", "GT", "GTE", "LT", "LTE", "NEQ", "PropertyFilter", "annual_series", "around_points", "coverage", "dense_chunks",
    "densify", "export_points", "find_cubes", "find_cubes_for", "in_boxes", "locate", "locate_two_step", "match", "match_saved",
    "missing_points", "nearest_on_axes", "resample", "running_mean", "search", "search_many", "search_zoned", "series_from_chunks",
    "stream_hrefs", "time_series", "write_clustered", "write_series", "write_zones",
]
