"""Rules: every constant the metric definitions depend on, in one place.

Names of people never appear in code; they are rows of the small lookup
tables held here and are passed to the operators as arguments.
"""

from __future__ import annotations

from dataclasses import dataclass, field


# --- fixed values that must equal the reference's for identical results ---
# Title patterns of the allowlist rule (case-insensitive LIKE patterns).
TITLE_PATTERNS = ("%customer success manager%", "csm%")
TITLE_EXACT = "CSM"
# Role prefixes that exclude a user (case-insensitive LIKE patterns).
ROLE_EXCLUDE_PATTERNS = ("Manager%", "VP%")
# Working location that excludes a user (case-insensitive LIKE pattern).
LOCATION_EXCLUDE_PATTERN = "%australia%"
# Daily touch target by segment text, checked in this order; else 4.0.
SEGMENT_TARGETS = (("%phone%", 2.5), ("%platform%", 2.5), ("%mid%", 3.0), ("%strategic%", 1.5))
DEFAULT_TARGET = 4.0
# Touch-status cut-offs (green, yellow) by segment; else (3.3, 2.0).
STATUS_CUTOFFS = (
    (("%phone%", "%platform%"), 2.0, 1.0),
    (("%mid%",), 2.5, 1.2),
    (("%strategic%",), 1.2, 0.7),
)
DEFAULT_CUTOFFS = (3.3, 2.0)
# Segments for which the renewal pillar is never counted.
NO_RENEWAL_PILLAR_PATTERNS = ("%phone%", "%platform%")
# Composite band cut-offs.
GREEN_AT = 0.80
YELLOW_AT = 0.50
# Qualifying call length.
MIN_CALL_MINUTES = 15
MIN_CALL_SECONDS = 900
# SLA deadline offset in days by weekday of creation (0=Sun .. 6=Sat).
SLA_OFFSET_BY_WEEKDAY = (2, 2, 2, 2, 4, 4, 3)
# HR vertical (upper-cased) -> display label.
HR_VERTICAL_LABELS = (
    ("MEDSPA", "MedSpa"), ("HVAC", "HVAC"), ("OEM", "OEM"), ("FAM", "FAM"),
    ("EMERGING", "Emerging"), ("JEWELRY", "Jewelry"), ("AUTO", "Auto"),
    ("PLATFORM PARTNERSHIPS", "Platform Partnerships"),
)
# Primary (book) vertical -> display label.
BOOK_VERTICAL_LABELS = (
    ("Healthcare", "MedSpa"), ("Home Service", "HVAC"), ("Home Services", "HVAC"),
    ("Auto Services", "Auto"),
)
# Word delimiters of the warehouse's title-casing.
TITLE_CASE_DELIMITERS = " \t\n!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"
MONTH_TO_MONTH = "Month-to-Month"
RETENTION_CASE_TYPE = "Retention"
CONTRACT_ACTIVE = "Activated"
HIGH_RISK_LEVELS = ("high", "critical")
INCOMPLETE_QUALITY = "incomplete"
# --- end of fixed values ---


@dataclass(frozen=True)
class Rules:
    """Inputs that differ per deployment (names, ids, lookup rows)."""

    exclude_names: tuple[str, ...] = ()
    exception_names: tuple[str, ...] = ()
    action_record_type: str = "REVIEW"
    churn_task_slug: str = "churn_risk"
    onboarding_case_types: tuple[str, ...] = ("Onboarding A", "Onboarding B", "Onboarding C")
    partner_dealer_type: str = "Partner"
    segment_override: tuple[tuple[str, str], ...] = ()
    manager_override_reps: tuple[str, ...] = ()
    manager_override_label: str | None = None
    director_by_manager: tuple[tuple[str, str], ...] = field(default_factory=tuple)
    # windows in days: touch rate, retention SLA, churn tasks, call scores (and the
    # end of the period they are compared with), call scores of the older backfill, renewals
    touch_window_days: int = 30
    sla_window_days: int = 30
    churn_window_days: int = 30
    call_window_days: int = 30
    call_history_days: int = 60
    backfill_call_window_days: int = 90
    renewal_lookback_days: int = 120


def fixture_rules() -> Rules:
    """Rule rows used with the derived test fixtures (FIXTURES.md)."""
    return Rules(
        exclude_names=("Supplier#000000002",),
        exception_names=("Supplier#000000009",),
        segment_override=(("Supplier#000000004", "AI/SOA"),),
        manager_override_reps=("Supplier#000000005", "Supplier#000000006"),
        manager_override_label="NATION_24",
        # manager (account owner's nation) -> director: the region's first nation
        director_by_manager=(
            ("NATION_5", "NATION_0"), ("NATION_10", "NATION_0"), ("NATION_15", "NATION_0"), ("NATION_20", "NATION_0"),
            ("NATION_6", "NATION_1"), ("NATION_11", "NATION_1"), ("NATION_16", "NATION_1"), ("NATION_21", "NATION_1"),
            ("NATION_7", "NATION_2"), ("NATION_12", "NATION_2"), ("NATION_17", "NATION_2"), ("NATION_22", "NATION_2"),
        ),
    )
