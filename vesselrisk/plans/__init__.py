"""Plans: composed jobs (feature matrix, scoring, evaluation, causal, drift, quality)."""
