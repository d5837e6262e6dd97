"""Reading landing files, reading and writing tables."""
