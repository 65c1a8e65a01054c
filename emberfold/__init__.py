"""emberfold: geo-temporal hotspot and incident analytics as Spark DataFrame jobs."""
