"""Distribution and subscription analytics as lazy Spark DataFrame plans."""

from rivulet.session import build_session
from rivulet.sources.tables import Tables

__all__ = ["Tables", "build_session"]
