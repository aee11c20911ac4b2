"""pathkin: peer and course recommendation expressed as Spark plans."""

from pathkin.domain import Domain
from pathkin.params import Params

__all__ = ["Domain", "Params"]
