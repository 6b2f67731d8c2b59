"""Long-running queries between topics and tables."""

from .jobs import (alert_job, alerts_from, devices_from, enrichment_job, events_from, enriched_from, fan_out,
                   late_job)
from .late import Lateness
from .waiting import WaitingEvents

__all__ = ["Lateness", "WaitingEvents", "alert_job", "alerts_from", "devices_from", "enriched_from",
           "enrichment_job", "events_from", "fan_out", "late_job"]
