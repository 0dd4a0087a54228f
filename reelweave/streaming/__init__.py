"""Structured Streaming jobs: raw landing, daily revenue upsert with quarantine, windowed totals."""
