"""Binary-outcome table analytics as PySpark DataFrame operators."""

from binoscope.session import get_session, materialize, shared_folder
from binoscope.spec import TableSpec

__all__ = ["TableSpec", "get_session", "materialize", "shared_folder"]
