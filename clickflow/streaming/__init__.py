"""Structured Streaming jobs for the ad-click stream."""
