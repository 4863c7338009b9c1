"""Sources and sinks: fixed relations, the test-table adapter, the lake, ingest."""
