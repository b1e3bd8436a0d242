"""Training-data pipeline operators (1-10); nothing else in the library imports this package."""
