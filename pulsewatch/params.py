"""Job parameters. The clock is always a parameter, never ``current_date``."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from statistics import NormalDist

# ---- fixed values: statistical settings of the detector --------------------
# Chi-square (1 degree of freedom) quantiles for the confidence levels in use.
CHI_SQUARE_CRITICAL = {
    0.975: 5.0238861873148934,
    0.9975: 9.140593461244016,
    0.999: 10.827566170662935,
    0.9995: 12.115665146397381,
}
MIN_HISTORY_ROWS = 25
FENCE_MULTIPLIER = 3.0
DROP_GUARD = 0.9
RISE_GUARD = 1.1
NEGATIVE_MARGIN_FLOOR_EURO = -1000.0
# ---- fixed values: labels and sentinels -------------------------------------
NOT_A_CAMPAIGN = "NOT A CAMPAIGN"
NO_CAMPAIGN_ID = -1
NO_CAMPAIGN_ATTRIBUTE = -11
SITE_LEVEL = "SITE LEVEL"
NOT_APPLICABLE = "N/A"
USD_CURRENCY_ID = 2
EXEC_AREA = "AMERICAS"
EXEC_RANKING = "TIER 1"
EXEC_EXCLUDED_VERTICALS = ("FILLER",)
# ---- fixed values: KPI names, in alert order --------------------------------
ALERT_KPIS = ("rext", "spend", "cos", "cr", "ctr")
ACCOUNT_FILL_METRICS = ("spend", "cos", "ctr", "cr", "rext")
TRACKED_KPIS = ("rext", "spend", "cos", "ctr", "cr", "clicks", "displays", "tac",
                "conversions", "order_value", "rext_euro")
# -----------------------------------------------------------------------------

# A series with more rows than this is not handed to one aggregation buffer:
# its quantiles are found by counting (operators.quantiles).
OVERSIZED_SERIES_ROWS = 100_000
# Key sets up to this size are broadcast to drop facts out of scope early.
BROADCAST_KEYS = 1_000_000


def chi_square_critical(confidence: float) -> float:
    """Quantile of the chi-square distribution with one degree of freedom: that of a squared normal variable."""
    if confidence in CHI_SQUARE_CRITICAL:
        return CHI_SQUARE_CRITICAL[confidence]
    return NormalDist().inv_cdf((1 + confidence) / 2) ** 2


@dataclass(frozen=True)
class KpiRule:
    """How one KPI is tested: confidence, direction, smallest absolute change."""

    confidence: float
    direction: str = "both"
    min_deviation: float | None = 1.0

    def __post_init__(self):
        if not 0 < self.confidence < 1:
            raise ValueError(f"confidence must lie between 0 and 1, not {self.confidence}")
        if self.direction.lower() not in ("neg", "pos", "both"):
            raise ValueError('direction must be "both", "pos" or "neg"')

    @property
    def critical(self) -> float:
        return chi_square_critical(self.confidence)


# ---- fixed values: rule per KPI ---------------------------------------------
KPI_RULES = {
    "events": KpiRule(0.975, "neg", 1.0),
    "cos": KpiRule(0.9995, "both", 0.0001),
    "ctr": KpiRule(0.999, "both", 0.0001),
    "cr": KpiRule(0.999, "both", 0.0001),
    "spend": KpiRule(0.9975, "both", 1.0),
    "rext": KpiRule(0.9975, "both", 1.0),
    "exec": KpiRule(0.975, "both", 1.0),
}
# -----------------------------------------------------------------------------


def rule_for(kpi: str) -> KpiRule:
    try:
        return KPI_RULES[kpi.lower()]
    except KeyError:
        raise ValueError(f"unknown KPI {kpi!r}; known: {', '.join(KPI_RULES)}") from None


@dataclass(frozen=True)
class RunParams:
    """What one daily run needs to know about its date, scope and limits."""

    today: date
    employee_filter: str = "true"
    client_filter: str = "true"
    account_window_days: int = 60
    live_window_days: int = 30
    required_days: int = 25
    beta_emails: tuple[str, ...] | None = None
    pod_leaders: tuple[str, ...] = ()
    oversized_rows: int = OVERSIZED_SERIES_ROWS
    broadcast_keys: int = BROADCAST_KEYS
    # folder of the daily sums kept from run to run (plans.daily_store); without one all facts of the window are read
    daily_store: str | None = None

    @property
    def yesterday(self) -> date:
        return self.today - timedelta(days=1)

    def days_ago(self, n: int) -> date:
        return self.today - timedelta(days=n)


@dataclass(frozen=True)
class DeliveryParams:
    """Recipients and texts of a product's notices; ``sent_at`` is the moment of the run in UTC."""

    sent_at: datetime
    geo: str = "Americas"
    product_label: str = "KPI"
    test_mode: bool = False
    test_email: str = "tester@example.test"
    maintainers: str = "maintainers@example.test"
    alias: str | None = None
    recipients: str | None = None
    cc: str | None = None
    beta_active: bool = False
    beta_testers: str | None = None
    summary_cc: dict[str, str] = field(default_factory=dict)
    channels: dict[str, str] = field(default_factory=dict)
    test_channel: str = "@tester"
    max_lines_per_message: int = 25
    separator: str = "  -  "
    timezone: str = "UTC"
    feedback_base: str = "http://feedback.example.test/submit"
    investigation_base: str = "http://explore.example.test/entry"
    dashboard_base: str = "http://dashboard.example.test/view"
    account_url_prefix: str = "http://accounts.example.test/?client="
    account_url_suffix: str = "&tab=overview"
