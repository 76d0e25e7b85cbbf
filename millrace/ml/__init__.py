"""Feature preparation, models and scoring."""
