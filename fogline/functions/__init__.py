"""Column expressions: time, text, geometry and display labels."""
