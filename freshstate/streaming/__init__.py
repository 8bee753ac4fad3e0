"""Structured Streaming jobs: keyed latest-state with TTL and flush emission
(T1/T2/T3), event-time windows (W2), keyed-topic and drop sinks (S7/S8/S10),
flush metrics (A7)."""
