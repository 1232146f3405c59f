"""Column, key and total operators over a pair of DataFrames."""
