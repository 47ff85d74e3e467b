"""Structured Streaming entry points.

The original pipeline is batch-only (whole files in, no event-time state),
so there is no windowed or stateful streaming operator to rebuild. What does
carry over is scoring (M16): a fitted model applied to feature rows as they
arrive. ``scoring.score_stream`` wires that onto ``readStream`` with the
same column expressions as the batch path.
"""
