"""Structured Streaming jobs: source, contract check, scoring, windowed metrics, alarm."""
