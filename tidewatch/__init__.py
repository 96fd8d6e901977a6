"""Telemetry analytics as Spark jobs: logs, metrics, traces and alerts of AI services.

Every operator is a function ``f(df, **params) -> DataFrame``; nothing is
collected on the driver and every operator works on batch DataFrames, most of
them on streaming DataFrames as well.
"""
