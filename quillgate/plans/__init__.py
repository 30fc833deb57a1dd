"""Stage jobs: each reads tables, runs operators and appends its results."""
