"""Data operators: keys, dimensions, facts, quality checks, cleaning steps, aggregates."""
