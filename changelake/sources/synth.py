"""Deterministic synthetic ``transactions`` rows.

Every column is a function of (id, seed) through SHA-256, never of
``rand()``: the rows do not change with partition count or retries.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Payment methods of the source table.
PAYMENT_METHODS = ("credit_card", "debit_card", "online_transfer")
# Our own small pick lists (not taken from any faker locale).
CITIES = ("Avonmere", "Brightwater", "Cobalt Bay", "Dunmore", "Eastvale", "Fairhaven", "Glenrock", "Highmoor")
COUNTRIES = ("Arvania", "Belmora", "Costara", "Delvia", "Estria")
COMPANIES = ("Acme Traders", "Blue Fern Ltd", "Copperline Inc", "Delta Works", "Evergreen Co", "Foxglove LLC")

AMOUNT_MIN_CENTS = 1_000
AMOUNT_MAX_CENTS = 100_000


def _h(seed: int, salt: str, id_col: str) -> Column:
    """Unsigned 60-bit integer from SHA-256 of (seed, salt, id)."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(salt), F.col(id_col).cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _pick(options: tuple[str, ...], h: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (h % len(options) + 1).cast("int"))


def _uuid_text(seed: int, salt: str, id_col: str) -> Column:
    hx = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.lit(salt), F.col(id_col).cast("string")), 256)
    return F.concat_ws(
        "-", F.substring(hx, 1, 8), F.substring(hx, 9, 4), F.substring(hx, 13, 4),
        F.substring(hx, 17, 4), F.substring(hx, 21, 12),
    )


def synth_transactions(ids: DataFrame, id_col: str = "id", seed: int = 42,
                       as_of: dt.datetime = dt.datetime(2024, 1, 1),
                       amount_type: str = "decimal(18,2)") -> DataFrame:
    """One transaction per input id.

    amount: uniform cents in [10.00, 1000.00] as ``amount_type`` (e.g.
    ``decimal(10,2)`` for the MySQL table); timestamp: ``as_of`` plus up to
    one day, whole seconds (TIMESTAMP_NTZ); payment method one of three.
    """
    span = AMOUNT_MAX_CENTS - AMOUNT_MIN_CENTS + 1
    cents = F.lit(AMOUNT_MIN_CENTS) + _h(seed, "amount", id_col) % span
    base = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return ids.select(
        _uuid_text(seed, "txn", id_col).alias("transaction_id"),
        F.concat(F.lit("user_"), (_h(seed, "user", id_col) % 100000).cast("string")).alias("user_id"),
        F.timestamp_add("SECOND", _h(seed, "time", id_col) % 86400, base).alias("timestamp"),
        (cents.cast("decimal(18,0)") / F.lit(100)).cast(amount_type).alias("amount"),
        _pick(CITIES, _h(seed, "city", id_col)).alias("city"),
        _pick(COUNTRIES, _h(seed, "country", id_col)).alias("country"),
        _pick(COMPANIES, _h(seed, "merchant", id_col)).alias("merchant_name"),
        _pick(PAYMENT_METHODS, _h(seed, "payment", id_col)).alias("payment_method"),
        _uuid_text(seed, "affiliate", id_col).alias("affiliateId"),
    )
