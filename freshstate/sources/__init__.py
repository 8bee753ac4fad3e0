"""Sources and sinks: CSV reading lines, time-range/pod scans, the telemetry
store connector (Python Data Source), the sensor dictionary, keyed topics."""
