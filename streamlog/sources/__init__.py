"""Where logs come from and go to."""
