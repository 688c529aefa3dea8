"""Readers, the KPI tables on disk, and the adapter for the test tables."""
