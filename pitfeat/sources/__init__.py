"""Table readers and fixture derivations."""
from .tables import Tables, read_table, register_views

__all__ = ["Tables", "read_table", "register_views"]
