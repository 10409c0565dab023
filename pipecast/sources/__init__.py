"""Where tables come from and where results go."""

from pipecast.sources.readers import Sources, read_features_csv

__all__ = ["Sources", "read_features_csv"]
