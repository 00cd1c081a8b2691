"""Column functions that turn rows into messages and back."""
