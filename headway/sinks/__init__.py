"""Sinks: slice replacement and guarded upsert on partitioned parquet tables."""
