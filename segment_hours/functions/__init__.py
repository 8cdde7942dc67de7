"""Column functions: text fields, times and calendars, coordinates."""
