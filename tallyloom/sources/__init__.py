"""Where the seven source tables come from."""
