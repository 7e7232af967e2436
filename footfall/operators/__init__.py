"""DataFrame -> DataFrame operators of the four jobs: dwells, frequency, origin, attachment."""
