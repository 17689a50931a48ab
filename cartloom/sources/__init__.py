"""Message lists, landing files and stored tables."""
