"""Readers for landed snapshots and writers for derived partitions."""
