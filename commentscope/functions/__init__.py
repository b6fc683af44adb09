"""Column-level building blocks: fixed values, labels, text and time expressions."""
