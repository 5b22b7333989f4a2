"""Sales analytics on Spark DataFrames."""

from .functions import *  # noqa: F401,F403
from .operators import *  # noqa: F401,F403
from .plans import *  # noqa: F401,F403
from .sources import *  # noqa: F401,F403
