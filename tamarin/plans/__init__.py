"""Plan helpers: durable intermediate tables and skew handling."""
