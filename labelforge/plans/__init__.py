"""Query plans: operator pipelines over the driver tables, and their SQL oracles."""
