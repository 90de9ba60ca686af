"""Pure Column builders: labels, predicates and metrics."""
