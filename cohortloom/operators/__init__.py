"""DataFrame-to-DataFrame operators. None of them triggers a Spark action."""
