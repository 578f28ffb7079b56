"""Composite plans: the five marts, the views over them and touched-key refresh."""
