"""Training set, candidates, rating model and ranked predictions."""
