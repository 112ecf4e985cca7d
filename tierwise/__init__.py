"""Layered (Bronze, Silver, Gold) trip and weather analytics as Spark plans."""
