"""Structured Streaming forms: per-device state functions and job wiring."""
