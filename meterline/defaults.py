"""Values the reference's models fix; every operator takes them as parameters."""

from __future__ import annotations

import datetime as dt

# Fixed values of the reference's fact and mart filters.
FACT_DATE_MIN = dt.date(2023, 1, 1)
FACT_DATE_MAX = dt.date(2025, 5, 31)
MAX_PASSENGERS = 6
# Tolerance of the total-amount mismatch flag.
TOTAL_MISMATCH_TOLERANCE = 0.01
# Upper bounds of the accepted_range checks on staged trips.
TRIP_DISTANCE_RANGE = (0, 200)
FARE_AMOUNT_RANGE = (0, 1000)
# Accepted borough names of the zone dimension check.
ACCEPTED_BOROUGHS = ["Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR", "Unknown"]
# Lower bound of the pickup-date expression check on the fact table.
PICKUP_DATE_FLOOR = dt.date(2023, 1, 1)

# Largest dimension we broadcast after a bounded check: rows and approximate bytes.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
