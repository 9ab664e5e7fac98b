"""Table builds and the registered queries."""
