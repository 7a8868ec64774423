"""Sources and sinks: trip scans, processed tables, zone dimension, reports, models."""
