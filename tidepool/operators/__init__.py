"""DataFrame → DataFrame operators (lazy); sinks live in ``load``."""
