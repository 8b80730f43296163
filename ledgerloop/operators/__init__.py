"""DataFrame operators of the transfer-graph analysis."""
