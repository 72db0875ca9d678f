"""Orders enrichment, windowed totals, lateness, validation and audits on Spark."""
