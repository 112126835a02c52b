from vaultline.functions import derive, masks

__all__ = ["derive", "masks"]
