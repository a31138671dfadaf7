"""Query plans: reports, the end-to-end run, and the query registry."""
