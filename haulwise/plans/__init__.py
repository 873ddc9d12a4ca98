"""Query plans: star-schema assembly, the five marts, the batch job and the
registry of named queries."""
