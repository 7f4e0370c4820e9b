"""Column-level functions: parsing, tokenising and the scalar bundle."""
