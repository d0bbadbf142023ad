"""Sources: driver-table adapters, realtime feed snapshots, GTFS schedule files, warehouse tables."""
