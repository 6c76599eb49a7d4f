"""DataFrame operators: features, fingerprints, index joins and evaluation."""
