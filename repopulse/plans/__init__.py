"""The tables and reports: functions from DataFrames and Params to a DataFrame."""
