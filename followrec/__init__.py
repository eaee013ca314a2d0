"""followrec: follow recommendations on Spark.

Closest connections by time-decayed engagement, reputation from weekly
message text, second-degree recommendations with reasons, upsert/expiry
publishing and data-quality checks, all as lazy DataFrame functions driven by
an explicit :class:`Params`.
"""

from followrec.params import Params  # noqa: F401
