"""Column functions and fixed codes."""
