from vaultline.sources import generator, landing, tables

__all__ = ["generator", "landing", "tables"]
