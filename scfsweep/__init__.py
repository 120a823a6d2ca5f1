"""Perturbation-response analytics for simulation sweeps, on Spark DataFrames."""
