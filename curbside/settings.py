"""Values the results depend on, and the names of the tables."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the ride-event format.
REQUESTED = "ride_requested"
ASSIGNED = "driver_assigned"
STARTED = "trip_started"
COMPLETED = "trip_completed"
PAID = "payment_completed"
EVENT_TYPES = (REQUESTED, ASSIGNED, STARTED, COMPLETED, PAID)

# Fixed values of the quality rules.
FARE_MAX = 5000.0
DISTANCE_MIN_KM = 0.1
DISTANCE_MAX_KM = 500.0
DEAD_LETTER_MAX_PCT = 5.0
DRIVER_SHARE = 0.82
SCHEMA_VERSION = "1.0"
SILVER_VERSION = "1.0"

# Fixed values of the driver score.
UTILIZATION_WEIGHT = 0.6
EARNINGS_WEIGHT = 0.4
EARNINGS_FULL_MARK = 50.0

# Fixed values of surge pricing: ratio above, tier, recommended multiplier.
SURGE_STEPS = ((3.0, "EXTREME", 2.5), (2.0, "HIGH", 2.0), (1.5, "MODERATE", 1.5))
SURGE_FLOOR = ("NORMAL", 1.0)
SURGE_STATUS = {"EXTREME": "🔴 EXTREME", "HIGH": "🟠 HIGH", "MODERATE": "🟡 MODERATE"}
SURGE_STATUS_REST = "🟢 NORMAL"

# Fixed values of the event-time windows.
CITY_WINDOW = "1 minute"
DRIVER_WINDOW, DRIVER_SLIDE = "15 minutes", "5 minutes"
SURGE_WINDOW = "5 minutes"
CITY_WATERMARK = SURGE_WATERMARK = "5 minutes"
DRIVER_WATERMARK = "10 minutes"

TOPIC = "ride-events"
TRIGGER = "30 seconds"
MAX_OFFSETS_PER_TRIGGER = 50_000
#: Buckets of current state: a power of two well above the tasks that run at once on a small cluster.
BUCKETS = 64

SILVER_KEYS = ("ride_id", "event_type")
GOLD_KEYS = {
    "city_ride_metrics": ("window_start", "city"),
    "driver_utilization": ("window_start", "driver_id", "city"),
    "surge_pricing": ("window_start", "city"),
    "funnel_analysis": ("event_date", "city"),
}
BRONZE_PARTITIONS = SILVER_PARTITIONS = ("event_date", "city")
DEAD_LETTER_PARTITIONS = ("event_date",)
GOLD_PARTITIONS = {
    "city_ride_metrics": ("window_start_date",),
    "driver_utilization": ("window_start_date",),
    "surge_pricing": ("window_start_date",),
    "funnel_analysis": ("event_date",),
}
CLUSTER_COLUMNS = {
    "bronze": ("ride_id", "driver_id"),
    "silver": ("ride_id", "driver_id", "rider_id"),
    "city_ride_metrics": ("city", "window_start"),
    "driver_utilization": ("driver_id", "city"),
    "surge_pricing": ("city", "surge_tier"),
    "dead_letter": ("ride_id",),
}


@dataclass(frozen=True)
class Names:
    """Catalog names; the prefix keeps several deployments apart in one metastore."""

    prefix: str = "curbside"

    @property
    def databases(self) -> tuple[str, str, str]:
        return (f"{self.prefix}_bronze", f"{self.prefix}_silver", f"{self.prefix}_gold")

    def table(self, name: str) -> str:
        bronze, silver, gold = self.databases
        layer = {
            "ride_events_raw": bronze,
            "ride_events_dead_letter": bronze,
            "ride_events_clean": silver,
        }.get(name, gold)
        return f"{layer}.{name}"
