"""The few expressions the two SQL engines spell differently."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dialect:
    spark: bool

    def name(self, column: str) -> str:
        return f"`{column}`" if self.spark else f'"{column}"'

    def epoch_us(self, ts: str) -> str:
        return f"unix_micros(cast({ts} as timestamp))" if self.spark else f"epoch_us({ts})"

    def idiv(self, a: str, b: str) -> str:
        return f"({a}) div {b}" if self.spark else f"({a}) // {b}"

    def run_version(self, ts: str) -> str:
        month = f"date_trunc('month', {ts})"
        return f"date_format({month}, 'yyyyMMdd_HHmmss')" if self.spark else f"strftime({month}, '%Y%m%d_%H%M%S')"

    def text(self, expr: str) -> str:
        return f"cast({expr} as {'string' if self.spark else 'varchar'})"


SPARK = Dialect(True)
DUCK = Dialect(False)

# --- DuckDB only: what the SQL twins use again and again ---

RUN_TS = "try_strptime({v}, '%Y%m%d_%H%M%S')"
TS_TEXT = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def run_ts(version: str) -> str:
    return RUN_TS.format(v=version)


def epoch_ts(x: str) -> str:
    """Epoch integer of unknown unit to timestamp."""
    return (
        f"CASE WHEN {x} >= 1000000000000000000 THEN make_timestamp({x} // 1000)"
        f" WHEN {x} >= 1000000000000000 THEN make_timestamp({x})"
        f" WHEN {x} >= 1000000000000 THEN make_timestamp({x} * 1000)"
        f" WHEN {x} >= 1000000000 THEN make_timestamp({x} * 1000000) END"
    )


def hash_bucket(key: str, salt: str, buckets: int) -> str:
    return f"cast('0x' || substr(md5({key}::varchar || '{salt}'), 1, 8) as bigint) % {buckets}"


def text_of(body: str, ts: tuple[str, ...] = (), dates: tuple[str, ...] = (), flags: tuple[str, ...] = ()) -> str:
    """The result of ``body`` with times, dates and flags as text, see ``registry.as_text``."""
    changes = [f"{TS_TEXT.format(c=c)} AS {c}" for c in ts] + [f"cast({c} as varchar) AS {c}" for c in (*dates, *flags)]
    return f"SELECT * REPLACE ({', '.join(changes)}) FROM ({body})"
