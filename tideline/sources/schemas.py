"""Tables: columns, natural keys, and defaults of columns that a write may leave out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

INVESTORS = ("individual", "foreign_", "institution", "securities", "insurance", "trust", "bank", "other_fin", "pension", "private_fund", "other_corp")


@dataclass(frozen=True)
class Table:
    name: str
    keys: tuple[str, ...]
    ddl: str
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


_BARS = "volume bigint, trade_value bigint, source string"
TABLES = {
    t.name: t
    for t in (
        Table("stocks", ("code",), "code string, name string, market string, sector string, kind string"),
        Table("daily_bars", ("code", "date"), f"code string, date date, open int, high int, low int, close int, {_BARS}", {"source": "primary"}),
        Table("daily_bars_adjusted", ("code", "date"), f"code string, date date, open double, high double, low double, close double, {_BARS}", {"source": "primary"}),
        Table(
            "supply_demand",
            ("code", "date"),
            "code string, date date, close int, flu_rt double, acc_trde_qty bigint, " + ", ".join(f"{x} bigint" for x in INVESTORS) + ", source string",
            {"source": "primary"},
        ),
        Table("short_selling", ("code", "date"), "code string, date date, close int, volume bigint, short_qty bigint, short_balance bigint, short_ratio double, short_avg_price int, short_value bigint"),
        Table("credit_balance", ("code", "date"), "code string, date date, close int, new_qty bigint, repay_qty bigint, balance_qty bigint, balance_amt bigint, balance_rt double, credit_rt double"),
        Table("sector_index", ("code", "date"), "code string, date date, name string, open int, high int, low int, close int, volume bigint, trade_value bigint"),
        Table("shares_outstanding_history", ("code", "date"), "code string, date date, shares_outstanding bigint, source string, knowledge_date date", {"source": "primary"}),
        Table(
            "earnings",
            ("code", "period", "knowledge_date"),
            "code string, period string, knowledge_date date, avail_date date, netinc double, netinc_prior double, revenue double, revenue_prior double, op_income double, op_income_prior double",
        ),
        Table("consensus", ("code", "date"), "code string, date date, target_mean double, recomm_mean double, base_date string, fwd_eps double, prev_eps double, est_year string"),
        Table("delisted_stocks", ("code",), "code string, name string, market string, last_trade_date date, checked date"),
    )
}
