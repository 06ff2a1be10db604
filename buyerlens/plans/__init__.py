"""Feature, quality and reporting plans."""
