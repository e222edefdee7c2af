"""Readers and writers: files, dated snapshots, JDBC, catalog tables."""
