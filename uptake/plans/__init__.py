"""The registered queries: operators over campaign tables derived from the given tables."""
