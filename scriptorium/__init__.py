"""A PySpark engine that turns noisy page text into clean, cross-referenced records."""
