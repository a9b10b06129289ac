"""Camera-trajectory, GPS-track, route-graph and mesh tables as Spark DataFrames."""
