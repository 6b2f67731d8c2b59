"""What a store table takes from its topic."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

from ..functions.geo import split_location


@dataclass(frozen=True)
class Dimension:
    """A stored column. ``multi_value`` keeps several sorted strings per row."""

    name: str
    kind: str = "string"          # string | long | float
    multi_value: bool = False


def _latitude(column: str) -> Callable[[], Column]:
    return lambda: split_location(column, "string")[0]


def _longitude(column: str) -> Callable[[], Column]:
    return lambda: split_location(column, "string")[1]


@dataclass(frozen=True)
class IngestSpec:
    """One store table.

    ``paths`` names JSON paths to read besides the top-level fields; ``derived``
    adds columns computed from fields read, each as a function that returns a
    Column. ``indexed`` string columns get a Bloom filter per file, so that a search
    for one value skips files, if ``values_per_file`` says how many distinct values a
    file is expected to have: without it a filter takes 1 MB, which is more than most
    files of a micro-batch. Only ``dimensions`` and the event time ``__time`` are kept. A message
    without a time column, or whose time is missing or unreadable, takes ``missing_time``, or is
    skipped when that is None.
    """

    name: str
    time_column: str | None
    dimensions: tuple[Dimension, ...]
    time_form: str = "iso"                      # iso | auto
    missing_time: str | None = None
    paths: dict[str, str] = field(default_factory=dict)
    derived: dict[str, Callable[[], Column]] = field(default_factory=dict)
    reads: tuple[str, ...] = ()                 # fields only ``derived`` needs
    partition_by_day: bool = True
    keep_nulls: bool = False
    rows_per_file: int = 5_000_000
    indexed: tuple[str, ...] = ("deviceId",)
    values_per_file: int = 0
    rollup: bool = False

    def __post_init__(self) -> None:
        if self.rollup:
            raise ValueError("rows are stored as they are; rollup is not supported")
        names = [d.name for d in self.dimensions]
        if len(set(names)) != len(names):
            raise ValueError(f"duplicate dimension in {self.name}")
        if "__time" in names or self.time_column in names:
            raise ValueError(f"the time column of {self.name} is kept as __time only")


# The three tables; names, patterns and limits are fixed values.
DEVICES = IngestSpec(
    name="DEVICES",
    time_column=None,
    time_form="auto",
    missing_time="2010-01-01T00:00:00.000Z",
    dimensions=(
        Dimension("payload.location.city"),
        Dimension("payload.location.countryCode"),
        Dimension("location"),
        Dimension("payload.location.region"),
        Dimension("payload.location.timezone"),
        Dimension("deviceId"),
        Dimension("latitude", "float"),
        Dimension("longitude", "float"),
    ),
    paths={
        "payload.location.city": "$.payload.location.city",
        "payload.location.countryCode": "$.payload.location.countryCode",
        "location": "$.payload.location.loc",
        "payload.location.region": "$.payload.location.region",
        "payload.location.timezone": "$.payload.location.timezone",
    },
    derived={"latitude": _latitude("location"), "longitude": _longitude("location")},
    partition_by_day=False,
    keep_nulls=True,
)

EVENTS_GEO = IngestSpec(
    name="EVENTS_GEO",
    time_column="eventTimestamp",
    dimensions=(
        Dimension("deviceId"),
        Dimension("deviceCity"),
        Dimension("deviceRegion"),
        Dimension("messageName"),
        Dimension("eventNotificationName"),
        Dimension("timestamp"),
        Dimension("deviceLatitude", "float"),
        Dimension("deviceLongitude", "float"),
    ),
    derived={"deviceLatitude": _latitude("deviceLocation"),
             "deviceLongitude": _longitude("deviceLocation")},
    reads=("deviceLocation",),
)

ALERTS = IngestSpec(
    name="ALERTS",
    time_column="window_end",
    dimensions=(
        Dimension("window_start"),
        Dimension("total_count_per_deviceid", "long"),
        Dimension("deviceId"),
        Dimension("avg_error_count", "long"),
        Dimension("std_error_count", "long"),
        Dimension("deviceLatitude", "float"),
        Dimension("deviceLongitude", "float"),
    ),
    derived={"deviceLatitude": _latitude("deviceLocation"),
             "deviceLongitude": _longitude("deviceLocation")},
    reads=("deviceLocation",),
)
