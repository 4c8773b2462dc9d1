"""The three end-to-end studies, each one lazy chain of operators."""
