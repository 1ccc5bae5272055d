"""The session of the other tests serves these too."""
