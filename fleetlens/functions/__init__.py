"""Column functions."""

from .geo import (bounding_box, disrupted, geo_distance_km, offset_position,
                  pack_location, split_location, within_disk,
                  within_radius)
from .json import json_value
from .records import (device_record, event_record, random_device_id, sorted_values,
                      stable_device_id)
from .time import (as_utc, duration_micros, iso_millis, iso_text, parse_clock, parse_time, time_literal,
                   utc_date)

__all__ = [
    "as_utc", "bounding_box", "device_record", "disrupted", "duration_micros", "event_record",
    "geo_distance_km", "iso_millis", "iso_text", "json_value", "offset_position",
    "pack_location", "parse_clock", "parse_time", "random_device_id",
    "sorted_values", "split_location", "stable_device_id", "time_literal", "utc_date", "within_disk",
    "within_radius",
]
