"""joinscope: join lineage and data-product analytics over SQL query logs, on Spark."""
