"""Business parameters of a run.

A ``Params`` value is built once on the driver, checked there, and reaches the
executors only as literals inside column expressions.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from decimal import Decimal, InvalidOperation
from types import MappingProxyType
from zoneinfo import ZoneInfo

from pyspark.sql import SparkSession

from daybook.errors import CurrencyError, ParamError

CONF_PREFIX = "spark.daybook."

# Defaults every installation starts from.
DEFAULT_RATES = {"USD": Decimal("130.0"), "ETB": Decimal("1.0")}
DEFAULT_REVENUE_STATUSES = ("paid", "partially_paid", "partially_refunded")
DEFAULT_EXCLUDED_STATUSES = ("pending", "cancelled", "refunded", "voided")

_DECIMALS = (
    "cogs_percentage",
    "admin_hours_per_week",
    "roas_green_threshold",
    "roas_amber_threshold",
    "dq_rejection_threshold",
)
_FRACTIONS = ("cogs_percentage", "dq_rejection_threshold")
_CURRENCIES = ("reporting_currency", "orders_currency", "ads_currency")
_STATUS_SETS = ("revenue_statuses", "excluded_statuses")


@dataclass(frozen=True)
class Params:
    """Validated parameters; every field has a default."""

    reporting_timezone: str = "Africa/Addis_Ababa"
    reporting_currency: str = "ETB"
    orders_currency: str = "ETB"
    ads_currency: str = "USD"
    #: units of the reporting currency per one unit of the named currency
    fx_rates: Mapping[str, Decimal] = field(default_factory=lambda: dict(DEFAULT_RATES))
    cogs_percentage: Decimal = Decimal("0.40")
    admin_hours_per_week: Decimal = Decimal("4.0")
    revenue_statuses: frozenset[str] = frozenset(DEFAULT_REVENUE_STATUSES)
    excluded_statuses: frozenset[str] = frozenset(DEFAULT_EXCLUDED_STATUSES)
    roas_green_threshold: Decimal = Decimal("3.0")
    roas_amber_threshold: Decimal = Decimal("1.5")
    dq_rejection_threshold: Decimal = Decimal("0.05")

    def __post_init__(self) -> None:
        put = lambda name, value: object.__setattr__(self, name, value)

        _check_timezone(self.reporting_timezone)
        for name in _CURRENCIES:
            put(name, _currency_code(name, getattr(self, name)))
        for name in _DECIMALS:
            put(name, _decimal(name, getattr(self, name)))
        for name in _STATUS_SETS:
            put(name, frozenset(getattr(self, name)))
        rates = {code.upper(): _decimal(f"rate of {code}", r) for code, r in self.fx_rates.items()}
        put("fx_rates", MappingProxyType(rates))

        for code, rate in rates.items():
            if rate <= 0:
                raise ParamError(f"the rate of {code} must be positive, not {rate}")
        for name in _FRACTIONS:
            if not 0 <= getattr(self, name) <= 1:
                raise ParamError(f"{name} must lie between 0 and 1, not {getattr(self, name)}")
        if self.admin_hours_per_week < 0:
            raise ParamError("admin_hours_per_week must not be negative")
        if self.roas_amber_threshold <= 0 or self.roas_green_threshold <= 0:
            raise ParamError("ROAS thresholds must be positive")
        if self.roas_amber_threshold >= self.roas_green_threshold:
            raise ParamError(
                f"the amber ROAS threshold {self.roas_amber_threshold} must lie below "
                f"the green one, {self.roas_green_threshold}"
            )
        if self.reporting_currency in (self.orders_currency, self.ads_currency):
            own_rate = rates.get(self.reporting_currency, Decimal(1))
            if own_rate != 1:
                raise ParamError(
                    f"{self.reporting_currency} is also a source currency, so its rate "
                    f"must be 1, not {own_rate}"
                )

    def rate_from(self, currency: str) -> Decimal:
        """Units of the reporting currency per one unit of ``currency``."""
        code = currency.upper()
        if code == self.reporting_currency:
            return Decimal(1)
        if code not in self.fx_rates:
            raise CurrencyError(f"no rate from {code} to {self.reporting_currency} is set")
        return self.fx_rates[code]

    @property
    def row_settings(self) -> str:
        """The parameters on which clean rows and daily sums depend, as one text."""
        rates = sorted((code, str(rate.normalize())) for code, rate in self.fx_rates.items())
        return repr(
            (
                self.reporting_timezone,
                self.reporting_currency,
                self.orders_currency,
                self.ads_currency,
                sorted(self.revenue_statuses),
                rates,
            )
        )

    @property
    def known_statuses(self) -> frozenset[str]:
        return self.revenue_statuses | self.excluded_statuses

    @classmethod
    def from_session(cls, spark: SparkSession, **overrides: object) -> Params:
        """Arguments first, then ``spark.daybook.<field>`` settings, then defaults.

        Sets are comma separated; a rate is ``spark.daybook.fx.<currency>``.
        """
        chosen: dict[str, object] = {}
        for f in fields(cls):
            text = spark.conf.get(CONF_PREFIX + f.name, None)
            if text is None or f.name == "fx_rates":
                continue
            chosen[f.name] = (
                frozenset(part.strip() for part in text.split(",") if part.strip())
                if f.name in _STATUS_SETS
                else text
            )
        rates = dict(DEFAULT_RATES)
        for key, value in spark.conf.getAll.items():
            if key.startswith(CONF_PREFIX + "fx."):
                rates[key.removeprefix(CONF_PREFIX + "fx.").upper()] = value
        chosen["fx_rates"] = rates
        chosen.update(overrides)
        return cls(**chosen)


def _check_timezone(name: str) -> None:
    try:
        ZoneInfo(name)
    except Exception as exc:
        raise ParamError(f"{name!r} is not a time zone this system knows") from exc


def _currency_code(field_name: str, value: str) -> str:
    code = str(value).upper()
    if len(code) != 3 or not code.isalpha():
        raise ParamError(f"{field_name} must be three letters, not {value!r}")
    return code


def _decimal(field_name: str, value: object) -> Decimal:
    try:
        number = Decimal(str(value))
    except InvalidOperation as exc:
        raise ParamError(f"{field_name} is not a number: {value!r}") from exc
    if not number.is_finite():
        raise ParamError(f"{field_name} is not a finite number: {value!r}")
    return number
