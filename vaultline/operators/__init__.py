from vaultline.operators import changes, dedup, privacy, quality, rollups, rules, velocity

__all__ = ["changes", "dedup", "privacy", "quality", "rollups", "rules", "velocity"]
