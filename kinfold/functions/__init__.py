from kinfold.functions.columns import (
    amount_of, ensure_columns, exact_amount, money_sum, money_units, orderable_columns, salt_of,
)
from kinfold.functions.text import (
    MAX_EDITS, edit_distance, full_name, near, own_pieces, possible_pieces, with_deletions,
)

__all__ = [
    "MAX_EDITS", "amount_of", "edit_distance", "ensure_columns", "exact_amount", "full_name", "money_sum", "money_units", "near",
    "orderable_columns", "own_pieces", "possible_pieces", "salt_of", "with_deletions",
]
