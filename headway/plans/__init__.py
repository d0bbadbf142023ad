"""Builders: raw, static, facts, marts, reports, quality."""
