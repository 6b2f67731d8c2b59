"""Small inputs with known answers."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

START = datetime(2023, 6, 15, 9, 0, 0)


def device(number: int, loc: str = "") -> str:
    loc = loc or f"47.{370000 + number},8.{520000 + number}"
    return json.dumps({"deviceId": f"d{number:02}", "payload": {"location": {
        "countryCode": "CH", "region": "Zurich", "city": "Zürich", "loc": loc,
        "timezone": "Europe/Zurich"}}}, ensure_ascii=False)


def event(device_id: str | None, when: datetime, notification: str = "accessGranted") -> str:
    stamp = when.isoformat(timespec="milliseconds") + "Z"
    return json.dumps({"deviceId": device_id, "messageName": "operatingNotification",
                       "payload": {"notificationName": notification, "eventTimestamp": stamp},
                       "timestamp": stamp})


def run_of_events(disrupted: int | None = None, devices: int = 20, minutes: int = 4) -> list[str]:
    """One event per device and second. Every device rejects once per half minute;
    ``disrupted`` rejects always."""
    out = []
    for second in range(minutes * 60):
        for number in range(devices):
            rejects = number == disrupted or (second + number) % 30 == 0
            out.append(event(f"d{number:02}", START + timedelta(seconds=second, milliseconds=number),
                             "accessRejected" if rejects else "accessGranted"))
    return out


def values(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")
