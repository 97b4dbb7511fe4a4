"""Report plans, run-log analytics, SQL texts and the query catalog."""
