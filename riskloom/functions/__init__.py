"""Pure Column functions: no action, no frame, no Python workers."""

from riskloom.functions.amounts import (  # noqa: F401
    band,
    exact_average,
    exact_total,
    log_amount,
    minor_units,
    percent_rounded,
    rate_above,
    rate_percent,
)
from riskloom.functions.categories import (  # noqa: F401
    MISSING,
    OTHER,
    best_model_text,
    cardinality_bucket,
    fill_missing_category,
    fill_missing_string,
    map_top_k,
    params_json,
    source_feature,
    strip_order_prefix,
    trimmed,
    weight_by_label,
)
from riskloom.functions.flags import any_present, equal_flag  # noqa: F401
from riskloom.functions.keys import fold_id, key_bucket, keep_fraction, portable_bucket  # noqa: F401
from riskloom.functions.times import (  # noqa: F401
    CyclicTimeEncoder,
    cyclic_pair,
    day_bucket,
    time_parts,
)
