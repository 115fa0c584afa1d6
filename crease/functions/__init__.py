"""Column helpers (all JVM-side expressions) and distributed sequence helpers."""
from crease.functions.metrics import (  # noqa: F401
    batting_totals, count_if, is_present, over_ball, phase, phase_order, rate, rate_or_zero,
)
from crease.functions.sequence import running_totals, sequential_ids  # noqa: F401
