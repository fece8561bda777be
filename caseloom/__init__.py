"""Clinical analytics on Spark DataFrames: ingest, clean, model as a star, query, test, train, explain."""

from caseloom.roles import Roles
from caseloom.session import build_session, shared_dir

__all__ = ["Roles", "build_session", "shared_dir"]
