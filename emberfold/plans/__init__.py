"""Compositions of operators: derived inputs, the detection/scoring/report jobs, queries."""
