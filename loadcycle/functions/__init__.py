"""Column expressions: no job, no UDF, everything inside whole-stage code generation."""
