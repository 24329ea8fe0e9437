"""Sinks: processed CSV files and warehouse tables."""
