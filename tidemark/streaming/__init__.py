"""Structured Streaming jobs and their batch forms."""
