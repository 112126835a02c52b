from vaultline.plans import bronze, customer_360, fraud_alerts, refresh, silver

__all__ = ["bronze", "customer_360", "fraud_alerts", "refresh", "silver"]
