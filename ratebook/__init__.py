"""Versioned price-list snapshots as Spark DataFrame jobs."""
