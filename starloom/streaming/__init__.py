from .refresh import read_refreshed, refresh_fact_immigration, refresh_star, start_refresh

__all__ = ["read_refreshed", "refresh_fact_immigration", "refresh_star", "start_refresh"]
