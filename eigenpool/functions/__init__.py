"""Column expressions: seeded noise, array arithmetic and display bands."""
