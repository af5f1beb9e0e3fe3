"""The reports: staging, intermediate and mart models, their build and their checks."""
