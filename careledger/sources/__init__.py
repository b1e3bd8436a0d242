"""Base tables: scans, the fixture adapter, agent config and date spines."""
