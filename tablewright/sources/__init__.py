"""Scans: delimited files, table sets, file manifests."""
