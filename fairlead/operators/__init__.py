"""Operators on DataFrames: normalising, joining, enriching, state, export, observation, serving."""
