"""Column expressions: cleaning, calendar arithmetic, bands, rates and money."""
