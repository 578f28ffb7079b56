"""Column expressions: factors, distances, time, JSON and validation rules."""
