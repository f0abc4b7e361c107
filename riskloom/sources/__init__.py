"""Reading typed tables and writing results."""
