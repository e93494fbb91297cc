from locrank.operators.checks import check_output
from locrank.operators.cycles import is_acyclic, is_acyclic_lineage
from locrank.operators.grouping import any_row_per_key, latest_per_key, one_row_per_key, sum_by
from locrank.operators.joins import (
    hot_keys,
    join_on_key,
    lost_keys,
    rows_per_key,
    rows_with_match,
    salted_join,
    spread_hash,
)
from locrank.operators.lineage import (
    consumers_of,
    contract_violations,
    derive_edges,
    fan_in,
    lines_by,
    outputs_of,
    producers_of,
    read_producers,
)
from locrank.operators.members import cycle_members, cycle_tasks
from locrank.operators.nearest import near_names, nearest_names
from locrank.operators.topk import top_k

__all__ = [
    "any_row_per_key",
    "check_output",
    "consumers_of",
    "contract_violations",
    "cycle_members",
    "cycle_tasks",
    "derive_edges",
    "fan_in",
    "hot_keys",
    "is_acyclic",
    "is_acyclic_lineage",
    "join_on_key",
    "latest_per_key",
    "lines_by",
    "lost_keys",
    "near_names",
    "nearest_names",
    "one_row_per_key",
    "outputs_of",
    "producers_of",
    "read_producers",
    "rows_per_key",
    "rows_with_match",
    "salted_join",
    "spread_hash",
    "sum_by",
    "top_k",
]
