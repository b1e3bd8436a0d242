"""Publishing results per as_of, dashboard runs and refresh on new data."""
