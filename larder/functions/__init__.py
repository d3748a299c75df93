"""Column expressions used by the cleaning steps and the views."""
