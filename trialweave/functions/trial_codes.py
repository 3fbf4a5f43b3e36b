"""Phase and status codes: labels, numbers and categories."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phase codes and their labels.
PHASE_LABELS = {
    "EARLY_PHASE1": "Early Phase 1",
    "PHASE1": "Phase 1",
    "PHASE2": "Phase 2",
    "PHASE3": "Phase 3",
    "PHASE4": "Phase 4",
    "PHASE1/PHASE2": "Phase 1/2",
    "PHASE2/PHASE3": "Phase 2/3",
    "PHASE3/PHASE4": "Phase 3/4",
}
NO_PHASE = "Not Applicable"
ALL_PHASES = (*PHASE_LABELS.values(), NO_PHASE)

# Statuses of each category.
STATUS_CATEGORIES = {
    "Active": (
        "Recruiting", "Not yet recruiting", "Active, not recruiting", "Enrolling by invitation",
    ),
    "Completed": ("Completed",),
    "Discontinued": ("Terminated", "Withdrawn"),
}
OTHER_STATUS = "Other"
COMPLETED = "Completed"


def phase_label(phase: Column) -> Column:
    """Readable label of a phase code; null and unknown codes are not applicable."""
    labels = F.create_map(*[F.lit(part) for pair in PHASE_LABELS.items() for part in pair])
    return F.coalesce(F.element_at(labels, phase), F.lit(NO_PHASE))


def phase_numeric(label: Column) -> Column:
    """Lowest phase number named in a label, null when there is none."""
    number = F.when(label.contains("Phase 1"), 1)
    for n in (2, 3, 4):
        number = number.when(label.contains(f"Phase {n}"), n)
    return number.cast("int")


def _plain(value: Column) -> Column:
    return F.regexp_replace(F.upper(value), "[^A-Z0-9]+", " ")


def _plain_literal(value: str) -> str:
    return re.sub("[^A-Z0-9]+", " ", value.upper())


def status_is(status: Column, values: tuple[str, ...], normalize: bool = False) -> Column:
    """Whether ``status`` is one of ``values``, exactly or ignoring case and punctuation."""
    if normalize:
        return _plain(status).isin(*[_plain_literal(value) for value in values])
    return status.isin(*values)


def status_category(status: Column, normalize: bool = False) -> Column:
    """Active / Completed / Discontinued / Other."""
    (name, values), *rest = STATUS_CATEGORIES.items()
    category = F.when(status_is(status, values, normalize), name)
    for name, values in rest:
        category = category.when(status_is(status, values, normalize), name)
    return category.otherwise(OTHER_STATUS)
