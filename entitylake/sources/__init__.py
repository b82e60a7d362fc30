"""Readers and writers: page lake, records, CSV, snapshots, attribute documents."""
