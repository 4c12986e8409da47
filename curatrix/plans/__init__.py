"""The composed jobs. Each takes and returns DataFrames; sinks are separate calls."""
