"""Column functions: text cleaning, names and paths, vectors."""
