"""Where messages come from and where tables live."""
