"""Event tables: lifecycle, reads in time, upkeep."""
