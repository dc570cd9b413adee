"""Plans: flattening, reporting views, loads and checks."""
