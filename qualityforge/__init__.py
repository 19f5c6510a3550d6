"""Quality rules, compliant filtering, profiling, fidelity scoring and
rule-constrained synthetic tables on Spark DataFrames."""
