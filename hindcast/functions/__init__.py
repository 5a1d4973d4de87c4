"""Column functions: local time, calendars, minute differences."""
