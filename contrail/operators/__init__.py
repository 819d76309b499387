from contrail.operators import cdc, clean, keyed, lifecycle, scd2, state

__all__ = ["cdc", "clean", "keyed", "lifecycle", "scd2", "state"]
