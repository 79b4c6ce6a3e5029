"""Column expressions: built-in functions, and Arrow functions over whole batches where those measured faster."""
