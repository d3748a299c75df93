"""DataFrame-to-DataFrame steps: cleaning, participants, profiling, integrity checks."""
