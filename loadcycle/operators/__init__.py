"""DataFrame -> DataFrame steps, usable with ``df.transform``."""
