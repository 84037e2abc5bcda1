"""Column expressions: the business rules, all evaluated by Spark itself."""
