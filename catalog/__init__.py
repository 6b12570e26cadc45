"""The registered queries: each operator run over the test tables."""
