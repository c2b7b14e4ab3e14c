"""Readers and writers: text files, tables by path or JDBC, streams, envelopes."""
