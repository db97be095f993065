"""DataFrame -> DataFrame operators, the same for batch tables and micro-batches."""
