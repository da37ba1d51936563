"""workloom: job-market analytics and corpus preparation as Spark plans."""

__all__ = ["runtime"]
