from tillroll.plans import finance, inventory, loads, marketing, orders, products, users

__all__ = ["finance", "inventory", "loads", "marketing", "orders", "products", "users"]
