"""Joins, aggregates and filters on rows."""

from .alerts import (alerts_from_counts, closed_before, closed_counts, count_by_hop,
                     deviation_alerts, hop_counts, window_stats, with_bounds)
from .enrich import enrich, enrich_bounded, join_all
from .keys import distinct_keys, latest_per_key
from .places import locate
from .polygons import (covered_positions, crossing_edges, invalid_polygons, points_inside, polygon_cells,
                       polygon_edges, valid_polygons)
from .spread import broadcast_if_fits, spread_join

__all__ = [
    "alerts_from_counts", "broadcast_if_fits", "closed_before", "closed_counts", "count_by_hop", "covered_positions",
    "crossing_edges",
    "deviation_alerts", "distinct_keys", "enrich", "enrich_bounded", "hop_counts", "invalid_polygons",
    "join_all", "latest_per_key", "locate", "points_inside", "polygon_cells", "polygon_edges", "spread_join",
    "valid_polygons", "window_stats", "with_bounds",
]
