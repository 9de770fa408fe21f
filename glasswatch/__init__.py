"""Trust-and-safety analytics as plain DataFrame functions."""
