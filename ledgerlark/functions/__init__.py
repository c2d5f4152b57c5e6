from ledgerlark.functions.scalar import (  # noqa: F401
    blank_to_null, clipped_log1p, event_time, haversine_km, is_member, is_night, is_weekend,
    planar_distance, to_double, to_event_timestamp, to_long,
)
from ledgerlark.functions.hashing import gaussian, order_hash  # noqa: F401
