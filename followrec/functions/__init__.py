"""Scalar expressions used by the operators (built-in Spark functions only)."""

from followrec.functions.numeric import (  # noqa: F401
    SCALE,
    WEIGHT_TYPE,
    fixed8_text,
    round8,
    text_to_w8,
    weight_decimal,
)
from followrec.functions.text import (  # noqa: F401
    clean_text,
    first_link_description,
    tokens,
)
from followrec.functions.timefns import (  # noqa: F401
    date_folder,
    days_since,
    decay_remainder,
    epoch_seconds,
    iso_z_to_date,
    parse_ts_text,
    recent_follow,
    week_bin,
    week_bounds,
)
