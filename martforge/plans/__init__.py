"""End-to-end plans: the wide analytics table, quality suites, query catalog."""
