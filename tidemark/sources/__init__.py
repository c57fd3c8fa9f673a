"""Sources and sinks: landing JSON, Bronze tables, vendor payloads, seeds."""
