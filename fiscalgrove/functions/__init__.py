"""Column expressions (no UDFs)."""

from fiscalgrove.functions.scalars import *  # noqa: F401,F403
from fiscalgrove.functions.files import *  # noqa: F401,F403
