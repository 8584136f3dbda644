"""Social-finance content analytics as Spark DataFrame operators."""

from tidewire.session import configure, run_dir, shared_dir

__all__ = ["configure", "run_dir", "shared_dir"]
