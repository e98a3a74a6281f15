"""Column expressions: text cleaning, calendar, geometry and statistics."""
