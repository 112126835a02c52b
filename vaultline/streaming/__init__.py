from vaultline.streaming import changes, run

__all__ = ["changes", "run"]
