"""Table-level operators: grains, sequences, quantiles, pruning, graph, models."""
