"""The registered queries: test binding, per-family query and oracle tables."""
