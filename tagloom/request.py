"""Requests: filters on one resource, compiled to a column predicate."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

RANGE_KEYS = {"min", "max"}


@dataclass(frozen=True)
class Request:
    """A query object. Filters are AND-ed; a list value means any-of; ``{min, max}`` is inclusive at both ends."""

    filter: Mapping[str, Any] = field(default_factory=dict)
    metadata: Mapping[str, str] = field(default_factory=dict)
    root: Mapping[str, Any] = field(default_factory=dict)
    items: tuple[Mapping[str, Any], ...] = ()
    first_n: int = 0

    def with_filter(self, key: str, value: Any) -> Request:
        return replace(self, filter={**self.filter, key: value})

    def with_metadata(self, key: str, value: str) -> Request:
        return replace(self, metadata={**self.metadata, key: value})

    def with_root(self, key: str, value: Any) -> Request:
        return replace(self, root={**self.root, key: value})

    def with_items(self, *items: Mapping[str, Any]) -> Request:
        return replace(self, items=self.items + items)

    @classmethod
    def from_json(cls, text: str) -> Request:
        """Read a whole request from JSON: ``filter`` (with its ``metadata``), ``items``, the rest are root parameters."""
        body = json.loads(text)
        filters = dict(body.pop("filter", {}))
        metadata = {**filters.pop("metadata", {}), **body.pop("metadata", {})}
        items = tuple(body.pop("items", ()))
        return cls(filters, metadata, body, items)

    def min_updated(self) -> int | None:
        """Lower end of the ``lastUpdatedTime`` range, if any."""
        bounds = self.filter.get("lastUpdatedTime")
        return bounds.get("min") if isinstance(bounds, Mapping) else self.root.get("minLastUpdatedTime")

    def condition(
        self,
        fields: Mapping[str, Column] | None = None,
        timestamps: Mapping[str, Column] | None = None,
    ) -> Column:
        """Predicate over the table.

        ``fields`` maps a filter key to a column expression where the names differ. ``timestamps`` maps a
        millisecond key to the stored timestamp column it was derived from: the range is then stated on the
        stored column, where it reaches the file scan.
        """
        fields, timestamps = fields or {}, timestamps or {}
        parts: list[Column] = []
        for key, value in self.filter.items():
            if value is None:
                continue
            if isinstance(value, Mapping) and RANGE_KEYS.issuperset(value):
                parts += _range(key, value.get("min"), value.get("max"), fields, timestamps)
            elif isinstance(value, (list, tuple, set)):
                parts.append(fields.get(key, F.col(key)).isin(*value))
            else:
                parts.append(fields.get(key, F.col(key)) == F.lit(value))
        for key, value in self.metadata.items():
            parts.append(F.try_element_at(fields.get("metadata", F.col("metadata")), F.lit(key)) == F.lit(value))
        parts += _range(
            "lastUpdatedTime",
            self.root.get("minLastUpdatedTime"),
            self.root.get("maxLastUpdatedTime"),
            fields,
            timestamps,
        )
        folded = F.lit(True)
        for part in parts:
            folded = folded & part
        return folded


def _range(key, low, high, fields, timestamps) -> list[Column]:
    parts = []
    if key in timestamps:
        stored = timestamps[key]
        if low is not None:
            parts.append(stored >= utc_at(low))
        if high is not None:
            parts.append(stored < utc_at(high + 1))
        return parts
    column = fields.get(key, F.col(key))
    if low is not None:
        parts.append(column >= F.lit(low))
    if high is not None:
        parts.append(column <= F.lit(high))
    return parts


def utc_at(millis: int) -> Column:
    """A UTC wall-clock literal for an epoch millisecond."""
    return F.timestamp_millis(F.lit(millis)).cast("timestamp_ntz")
