"""Hotel funnel click-stream facts on Spark."""
