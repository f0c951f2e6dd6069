"""DataFrame-to-DataFrame operators; each one chains with ``df.transform``."""
