"""DataFrame → DataFrame operators of the competition and similarity jobs."""
