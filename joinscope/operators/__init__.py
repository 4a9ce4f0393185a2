"""DataFrame -> DataFrame steps: extraction, metrics, correlation, health, recommendations."""
