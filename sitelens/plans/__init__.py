"""The models: staging, intermediate and mart DataFrames."""
