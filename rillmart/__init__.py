"""Layered real-time commerce analytics as plain DataFrame functions.

Raw client logs and a database change log go in; clean fact streams, dimension
snapshots and tumbling-window summaries come out.  Every operator takes and
returns a DataFrame; ``df.isStreaming`` is looked at only where batch and stream
need different plans.
"""
