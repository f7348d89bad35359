"""Table operators: profiles, checks, cleaning, features, encoding, selection."""
