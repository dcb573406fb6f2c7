"""Sources and sinks: JDBC ingest, landing zone, report results, test-table mapping."""
