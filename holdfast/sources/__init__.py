"""Schemas, scans, snapshots and fixture views."""
