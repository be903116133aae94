"""Scans and sinks: CSV lake, JSON payloads, warehouse tables, adapters."""
