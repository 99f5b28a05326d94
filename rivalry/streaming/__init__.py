"""Streaming.

The jobs are batch jobs over date-partitioned tables.  The one incremental
piece is ``coview_daily``: a Structured Streaming query over the click log
that keeps daily co-view pair counts, so a co-view run sums the days of its
window instead of re-joining 91 days of clicks.  It computes the same result
as ``operators.coview.coview_switch`` (tested).
"""
