"""Controls: prepared inputs in, result DataFrames out, publishing apart."""
