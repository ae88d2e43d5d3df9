"""Batch sinks: set tables and the message-bus writer."""

from loadlens.sinks.writers import kafka_write, write_set_table

__all__ = ["kafka_write", "write_set_table"]
