"""Functions on columns. Names and meaning follow one dialect; where Spark's own function means the same it is used as is.

Arguments are columns or names of columns; literals may stand where the parameter is a plain value.
"""

from .aggregates import *  # noqa: F403
from .arrays import *  # noqa: F403
from .column_ops import *  # noqa: F403
from .context import *  # noqa: F403
from .core import *  # noqa: F403
from .datetimes import *  # noqa: F403
from .numeric import *  # noqa: F403
from .semistructured import *  # noqa: F403
from .strings import *  # noqa: F403
