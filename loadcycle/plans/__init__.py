"""The haul-cycle layers: raw, stage, presentation; consolidation of raw files; a small classifier."""
