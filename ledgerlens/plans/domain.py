"""Domain tables of the funding data model, kept as data.

Operators never hard-code these; they are passed in as small literal
tables or dicts.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal the analysed application's for equal results):
# the 21 round types in their column order, each with its stage category and
# its stage rank (higher = later stage).
# ---------------------------------------------------------------------------
ROUND_TYPES = [
    ("seed", "Early Stage", 1),
    ("venture", "Venture", 2),
    ("equity_crowdfunding", "Alternative", 1),
    ("undisclosed", "Undisclosed", 0),
    ("convertible_note", "Early Stage", 1),
    ("debt_financing", "Debt", 2),
    ("angel", "Early Stage", 1),
    ("grant", "Alternative", 1),
    ("private_equity", "Growth", 9),
    ("post_ipo_equity", "Late Stage / Public", 10),
    ("post_ipo_debt", "Late Stage / Public", 10),
    ("secondary_market", "Late Stage / Public", 10),
    ("product_crowdfunding", "Alternative", 1),
    ("round_A", "Venture", 2),
    ("round_B", "Venture", 3),
    ("round_C", "Venture", 4),
    ("round_D", "Growth", 5),
    ("round_E", "Growth", 6),
    ("round_F", "Growth", 7),
    ("round_G", "Growth", 8),
    ("round_H", "Growth", 9),
]

# Statuses that count as an exit, and the closed status.
EXIT_STATUSES = ["ipo", "acquired"]
CLOSED_STATUS = "closed"

# Reference date for ages in the test star (stands in for the
# configured analysis date) and the first-funding cut of the test star.
STAR_REFERENCE_DATE = "1997-01-01"
STAR_FUNDING_CUTOFF = "1996-07-01"

# Order priority → round-type column of the test star.
STAR_PRIORITY_ROUNDS = [
    ("1-URGENT", "seed"),
    ("2-HIGH", "venture"),
    ("3-MEDIUM", "debt_financing"),
    ("4-NOT SPECIFIED", "undisclosed"),
    ("5-LOW", "private_equity"),
]
STAR_ROUND_COLUMNS = [r for _, r in STAR_PRIORITY_ROUNDS]


def round_category() -> dict[str, str]:
    return {n: c for n, c, _ in ROUND_TYPES}


def round_rank() -> dict[str, int]:
    return {n: r for n, _, r in ROUND_TYPES}


def round_type_rows(columns=None) -> list[tuple[int, str, str, int]]:
    """``(round_type_id, round_type_name, stage_category, stage_rank)`` for the
    chosen columns, ids numbered in column order."""
    cat, rank = round_category(), round_rank()
    cols = columns or [n for n, _, _ in ROUND_TYPES]
    return [(i + 1, c, cat[c], rank[c]) for i, c in enumerate(cols)]
