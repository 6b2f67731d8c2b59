"""Store tables: how messages become rows, how rows are kept, read and reported."""

from .lookups import Lookup
from .maintenance import (compact, delete_all, delete_interval, disable, enable, remove_unused,
                          replace_interval)
from .reports import (alerts_on_map, device_map, query_messages, rejected_over_time,
                      save_result)
from .sketches import day_sketches, distinct_count, merged, quantile
from .specs import ALERTS, DEVICES, EVENTS_GEO, Dimension, IngestSpec
from .store import (LoadReport, as_messages, list_days, load, load_history, load_stream, read_table,
                    reset_stream, scan, shape, shape_counted)

__all__ = [
    "ALERTS", "DEVICES", "Dimension", "EVENTS_GEO", "IngestSpec", "LoadReport", "Lookup",
    "alerts_on_map",
    "as_messages", "compact", "day_sketches", "delete_all", "delete_interval", "device_map", "disable", "distinct_count", "enable",
    "list_days", "load", "load_history", "load_stream", "merged", "quantile", "query_messages", "read_table",
    "rejected_over_time", "remove_unused", "replace_interval", "reset_stream", "save_result", "scan",
    "shape", "shape_counted",
]
