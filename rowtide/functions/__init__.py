"""Column and row-shape functions: change-event encode and decode."""
