"""Table contracts and the places tables are read from."""
