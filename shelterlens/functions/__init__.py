"""Column expressions: calendar arithmetic and predicates with the reports' null semantics."""
