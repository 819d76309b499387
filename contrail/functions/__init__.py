from contrail.functions import columns, time

__all__ = ["columns", "time"]
