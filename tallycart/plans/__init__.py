"""Feature families and the matrices built from them."""
