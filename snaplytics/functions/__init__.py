"""Column expressions (scalar functions) used by the operators and jobs."""

from snaplytics.functions.expressions import *  # noqa: F401,F403
from snaplytics.functions.expressions import __all__  # noqa: F401
