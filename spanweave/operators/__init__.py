"""Table operators: DataFrames carrying key columns in, DataFrames out."""
