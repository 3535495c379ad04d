"""Incremental, change-event, paged and sharded reads."""
