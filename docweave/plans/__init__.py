"""Registered queries (Spark plans) and their SQL twins."""

from .registry import ORACLE, QUERIES  # noqa: F401
from . import q_xpath  # noqa: F401  (registers queries)
from . import q_web  # noqa: F401
from . import q_html  # noqa: F401
from . import q_channels  # noqa: F401
from . import q_crawl  # noqa: F401
from . import q_stream  # noqa: F401
from . import q_rss  # noqa: F401
