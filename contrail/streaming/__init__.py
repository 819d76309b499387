from contrail.streaming import feeds

__all__ = ["feeds"]
