"""Labels of anomalies and events, and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The namespace of URLs in RFC 4122, and the prefix of an event's name.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
EVENT_PREFIX = "warm_event"


def status(anomaly: Column) -> Column:
    return (
        F.when(anomaly.isNull(), "Unknown").when(anomaly >= 1.5, "Extreme").when(anomaly >= 1.0, "Hot").when(anomaly >= 0.5, "Watch").otherwise("Normal")
    )


def severity(exceedance: Column) -> Column:
    """Of the unrounded highest exceedance of an event."""
    return (
        F.when(exceedance.isNull(), "Unknown").when(exceedance >= 2, "Extreme").when(exceedance >= 1, "Severe").when(exceedance >= 0.5, "Moderate")
        .when(exceedance > 0, "Weak").otherwise("Threshold-only")
    )


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """Name-based UUID, version 5."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"),
        variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12),
    )


def event_id(entity: Column, start: Column) -> Column:
    return uuid5(F.concat(F.lit(f"{EVENT_PREFIX}|region_id="), entity.cast("string"), F.lit("|start_date="), F.date_format(start, "yyyy-MM-dd")))
