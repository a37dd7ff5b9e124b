"""Job specs, the composite spec-driven jobs and the query catalogue."""
