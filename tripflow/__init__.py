"""Trip-event analytics on Spark: validate, store, roll up, score and watch taxi trips."""

from tripflow.session import adopt, build_session
from tripflow.settings import Settings

__all__ = ["Settings", "adopt", "build_session"]
