from contrail.plans import kpis, marts, medallion, quality, rollups, serving

__all__ = ["kpis", "marts", "medallion", "quality", "rollups", "serving"]
