"""Where DataFrames come from: CSV files, stored tables, the date spine, the star-schema test tables."""
