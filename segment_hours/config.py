"""Feature configuration as plain dataclasses."""

from __future__ import annotations

from dataclasses import dataclass

SEGMENT = "ELR_MIL"
DATE_KEYS = ["year", "month", "day", "hour"]
HOUR_KEYS = [SEGMENT, *DATE_KEYS]
# One folder per segment and day holds 24 rows; stored tables default to months, sorted by segment.
PARTITION_KEYS = [SEGMENT, "year", "month", "day"]
MONTH_KEYS = ["year", "month"]
INCIDENT_PREFIX = "INCIDENT_"

# Miles per segment bucket and the widest point-to-line distance in metres.
SEGMENT_MILES = 8
MAX_DISTANCE_M = 1000.0


@dataclass(frozen=True)
class Rolling:
    """``action`` of ``column`` over the ``hours`` up to and including the current one."""

    column: str
    action: str
    hours: int

    @property
    def name(self):
        return f"{self.column}_{self.action}_{self.hours}h"


@dataclass(frozen=True)
class Flag:
    """1 when the column reaches ``threshold`` within ``hours``: ``le`` from above, else from below."""

    name: str
    column: str
    action: str
    hours: int
    threshold: float


# The shipped weather features.
WEATHER_ROLLING = (
    Rolling("min_air_temp", "min", 48),
    Rolling("max_air_temp", "max", 48),
    Rolling("prcp_amt", "sum", 6),
    Rolling("snow_depth", "sum", 24),
)
WEATHER_FLAGS = (
    Flag("freeze", "min_air_temp", "le", 72, 0.0),
    Flag("heatwave", "max_air_temp", "ge", 72, 25.0),
)
