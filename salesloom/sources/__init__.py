"""Readers for API dumps and spreadsheet exports, table sinks and the load job."""
