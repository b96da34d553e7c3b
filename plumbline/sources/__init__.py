"""Reading and writing tables, reports, models and run logs."""
