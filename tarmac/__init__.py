"""tarmac: delay and service-quality analytics as Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function (or a ``Column``
builder) over built-in Spark operators, so Catalyst plans the whole chain:
scan pruning, filter pushdown, partial aggregation and exchange reuse.
"""

from tarmac.session import get_session

__all__ = ["get_session"]
