"""Haul-and-load cycle analytics as lazy Spark DataFrames.

``functions`` holds column expressions, ``operators`` holds DataFrame -> DataFrame steps usable
with ``df.transform``, ``sources`` reads and writes tables and ``plans`` chains all of them into
the raw, stage and presentation layers.
"""
