"""Column functions: months and calendars, numbers, text, hashes, labels."""

from .labels import *  # noqa: F401,F403
from .months import *  # noqa: F401,F403
from .numbers import *  # noqa: F401,F403
from .text import *  # noqa: F401,F403
