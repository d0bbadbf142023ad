"""headway: transit performance analytics as Spark DataFrame plans.

Layers: ``sources`` (feed snapshots, schedule CSV, warehouse tables, driver-table adapters),
``functions`` (column expressions), ``operators`` (reusable DataFrame operators), ``plans``
(raw / static / fact / mart / report builders and quality checks), ``sinks`` (slice replace,
guarded upsert), ``streaming`` (Structured Streaming front end for snapshot landing).
"""

__version__ = "0.1.0"
