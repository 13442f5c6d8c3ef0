from __future__ import annotations

from decimal import Decimal

import pytest

from daybook import CurrencyError, ParamError, Params


def test_defaults():
    p = Params()
    assert (p.reporting_currency, p.orders_currency, p.ads_currency) == ("ETB", "ETB", "USD")
    assert p.reporting_timezone == "Africa/Addis_Ababa"
    assert p.rate_from("USD") == Decimal("130.0")
    assert p.cogs_percentage == Decimal("0.40")
    assert p.dq_rejection_threshold == Decimal("0.05")
    assert "disputed" not in p.known_statuses and "voided" in p.known_statuses


@pytest.mark.parametrize(
    "wrong",
    [
        {"reporting_timezone": "Mars/Olympus_Mons"},
        {"reporting_currency": "E7B"},
        {"reporting_currency": "ETBX"},
        {"fx_rates": {"USD": Decimal("-1")}},
        {"fx_rates": {"USD": "0"}},
        {"cogs_percentage": "1.5"},
        {"cogs_percentage": "-0.1"},
        {"cogs_percentage": "lots"},
        {"cogs_percentage": "NaN"},
        {"dq_rejection_threshold": "1.01"},
        {"admin_hours_per_week": "-1"},
        {"roas_green_threshold": "1.5", "roas_amber_threshold": "3.0"},
        {"roas_green_threshold": "2", "roas_amber_threshold": "2"},
        {"roas_amber_threshold": "0"},
        {"fx_rates": {"ETB": "2.0"}},
        {"reporting_currency": "USD"},
    ],
)
def test_wrong_values_are_refused(wrong):
    with pytest.raises(ParamError):
        Params(**wrong)


def test_codes_are_upper_case():
    p = Params(reporting_currency="etb", ads_currency="usd", fx_rates={"usd": 120})
    assert p.reporting_currency == "ETB"
    assert p.rate_from("usd") == Decimal(120)


def test_rate_of_the_reporting_currency_is_one():
    assert Params().rate_from("etb") == 1
    assert Params(reporting_currency="USD", fx_rates={"USD": 1, "ETB": "0.008"}).rate_from(
        "ETB"
    ) == Decimal("0.008")


def test_unknown_currency():
    with pytest.raises(CurrencyError, match="no rate from GBP"):
        Params().rate_from("GBP")


def test_session_settings_lie_between_arguments_and_defaults(spark):
    settings = {
        "spark.daybook.reporting_currency": "usd",
        "spark.daybook.cogs_percentage": "0.3",
        "spark.daybook.fx.usd": "1.0",
        "spark.daybook.revenue_statuses": "paid, settled",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        p = Params.from_session(spark, cogs_percentage=Decimal("0.2"))
        assert p.reporting_currency == "USD"
        assert p.rate_from("USD") == 1
        assert p.revenue_statuses == {"paid", "settled"}
        assert p.cogs_percentage == Decimal("0.2")
        assert p.admin_hours_per_week == Decimal("4.0")
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert Params.from_session(spark) == Params()
