"""Sources: monthly payment CSV files, and the benchmark tables mapped to payment rows."""
