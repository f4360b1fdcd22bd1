"""Column expressions over text-typed raw data."""
