"""DataFrame -> DataFrame operators of a listing run."""
