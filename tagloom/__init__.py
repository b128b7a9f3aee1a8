"""tagloom: industrial resource data (assets, events, series, files, raw rows) on Spark DataFrames."""

from tagloom.request import Request

__all__ = ["Request"]
