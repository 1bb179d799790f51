"""Deduplication of event streams."""


def dedup_exact(events):
    """One row per event id for ever; the state grows with the ids seen."""
    return events.dropDuplicates(["event_id"])


def dedup_watermark(events, delay="15 minutes"):
    """One row per event id, remembered for the watermark delay only."""
    return events.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_id"])


def dedup_logical(events, delay="15 minutes", keys=("order_id", "event_type", "event_time")):
    """One row per logical event: re-sent copies have a new event id but the same key."""
    rows = events.withWatermark("event_time", delay) if events.isStreaming else events
    return rows.dropDuplicates(list(keys))
