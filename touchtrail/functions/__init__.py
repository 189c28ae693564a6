"""Column helpers: cleaning, dates, ratios and text formatting."""
