"""Column expressions shared by the operators; all stay in the JVM."""

from tallywright.functions.columns import (
    cycle,
    hash_draw,
    hour_text,
    padded_id,
    to_event_time,
)

__all__ = ["cycle", "hash_draw", "hour_text", "padded_id", "to_event_time"]
