from pitwall.plans.joins import bounded_broadcast, roster_semi_join  # noqa: F401
from pitwall.plans.sequence import (  # noqa: F401
    BLK,
    HALO,
    block_window,
    carry_forward,
    lag_lead,
    largest_key,
    longest_sequence,
    number_rows,
    number_rows_sized,
    with_blocks,
)
from pitwall.plans.lineage import materialize  # noqa: F401
