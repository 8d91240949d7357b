"""Small frames for the tests."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime
from decimal import Decimal

from vaultline import schemas

OPEN = datetime.fromisoformat(schemas.OPEN_END)
START = datetime(1900, 1, 1)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def transactions(spark, rows):
    """Rows of (id, time, card, type, amount, result, terminal)."""
    typed = [
        (i, ts(t) if isinstance(t, str) else t, c, kind, Decimal(str(a)), r, m)
        for i, t, c, kind, a, r, m in rows
    ]
    return spark.createDataFrame(typed, schemas.TRANSACTIONS_DDL)


def history(spark, dim, rows):
    """Rows of (key, tracked..., from, to, flag); None ends are open."""
    width = len(dim.tracked) + 1
    typed = [(*row[:width], row[width] or START, row[width + 1] or OPEN, row[width + 2]) for row in rows]
    return spark.createDataFrame(typed, dim.history_ddl)


def cards(spark, *rows):
    return history(spark, schemas.CARDS, [(c, a, None, None, "N") for c, a in rows])


def accounts(spark, *rows):
    return history(spark, schemas.ACCOUNTS, [(a, v and ts(v), k, None, None, "N") for a, v, k in rows])


def client(key, passport="P", valid_to=None, last="Last", first="First", middle="Middle", phone="1"):
    return (key, last, first, middle, None, passport, valid_to and ts(valid_to), phone)


def clients(spark, *rows):
    return history(spark, schemas.CLIENTS, [(*row, None, None, "N") for row in rows])


def terminals(spark, *rows):
    return history(spark, schemas.TERMINALS, [(t, "ATM", city, None, None, None, "N") for t, city in rows])


def blacklist(spark, *rows):
    return spark.createDataFrame([(p, ts(t)) for p, t in rows], schemas.BLACKLIST_DDL)


@contextmanager
def settings(spark, **conf):
    names = {name.replace("__", "."): value for name, value in conf.items()}
    old = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
