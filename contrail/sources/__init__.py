from contrail.sources import regions, snapshots, tables

__all__ = ["regions", "snapshots", "tables"]
