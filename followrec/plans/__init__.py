"""Query plans: the daily pipeline and the registered queries."""
