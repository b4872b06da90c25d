"""DataFrame operators: checks, routing, scoring, gate, metrics, versions."""
