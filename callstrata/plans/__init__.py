"""Business plans: every mart as a function from DataFrames to a DataFrame."""
