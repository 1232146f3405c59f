"""Where the two sides and the run settings are read from."""
