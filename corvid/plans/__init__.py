"""Plan inspection helpers and the oracle SQL of the registered queries."""
