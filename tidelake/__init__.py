"""tidelake: market-data lake and analytics operators on PySpark."""

from tidelake.session import get_session, materialize, shared_dir, use_utc

__all__ = ["get_session", "materialize", "shared_dir", "use_utc"]
