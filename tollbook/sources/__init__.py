"""Where records and tables come from."""
