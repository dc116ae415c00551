"""Relational operators of the change feed: filters, planning, events, snapshots and progress."""
