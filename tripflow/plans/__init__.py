"""Jobs: the compositions a user runs."""
