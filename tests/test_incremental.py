"""The refreshed report against the full one, after any sequence of loads."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from frames import OPEN, START, ts
from pyspark.sql import functions as F

from vaultline import schemas
from vaultline.plans.fraud import fraud_report
from vaultline.plans.incremental import IncrementalReport, changed_spans
from vaultline.sources.store import Store

DAY = datetime(2021, 3, 1)
REPORT_DT = ts("2021-04-01 00:00:00")


def full(store, **options):
    return fraud_report(
        store.read_fact(schemas.FACT_TRANSACTIONS, schemas.TRANSACTIONS_DDL),
        *[store.history(dim) for dim in (schemas.CARDS, schemas.ACCOUNTS, schemas.CLIENTS, schemas.TERMINALS)],
        store.read_fact(schemas.FACT_BLACKLIST, schemas.BLACKLIST_DDL),
        report_dt=REPORT_DT,
        **options,
    )


def bag(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def facts(spark, rng, day, n=40):
    rows = []
    for i in range(n):
        # Most events are of the day of their file, some are late, some on its last or first minutes.
        at = day + timedelta(seconds=rng.choice([rng.randrange(86_400), rng.randrange(600), 86_399 - rng.randrange(1800)]))
        at -= timedelta(days=rng.choice([0] * 9 + [1, 2]))
        kind = rng.choice(["PAYMENT", "WITHDRAW", "DEPOSIT"])
        rows.append((f"{day:%d}-{i}", at, f"c{rng.randrange(6)}", kind, rng.choice([10, 20, 30, 40]), rng.choice(["REJECT", "REJECT", "SUCCESS"]), f"T{rng.randrange(4)}"))
    return spark.createDataFrame(rows, schemas.TRANSACTIONS_DDL.replace("decimal(14,4)", "bigint")).withColumn("amt", F.col("amt").cast("decimal(14,4)"))


def versions(spark, rng, dim, values, day):
    """A history in which some keys change on the day of the load or earlier, and some vanish."""
    rows = []
    for key, own in values.items():
        if rng.random() < 0.1:
            continue
        if rng.random() < 0.5:
            cut = day - timedelta(days=rng.choice([0, 0, 0, 2]), hours=rng.randrange(12))
            rows.append((key, *own(), START, cut, "N"))
            rows.append((key, *own(), cut + timedelta(seconds=1), OPEN, rng.choice(["N", "N", "N", "Y"])))
        else:
            rows.append((key, *own(), START, OPEN, "N"))
    return spark.createDataFrame(rows, dim.history_ddl)


def load_dimension(spark, store, rng, which, day):
    ends = lambda: day + timedelta(days=rng.choice([-3, -1, 0, 30]), hours=rng.randrange(24))
    made = {
        "cards": (schemas.CARDS, {f"c{i}": lambda: (f"a{rng.randrange(4)}",) for i in range(6)}),
        "accounts": (schemas.ACCOUNTS, {f"a{i}": lambda: (ends(), f"k{rng.randrange(4)}") for i in range(4)}),
        "clients": (schemas.CLIENTS, {f"k{i}": lambda: ("L", "F", rng.choice(["x", "y"]), None, f"p{rng.randrange(4)}", rng.choice([None, ends()]), "1") for i in range(4)}),
        "terminals": (schemas.TERMINALS, {f"T{i}": lambda: ("ATM", rng.choice(["north", "south", None]), "s") for i in range(4)}),
    }[which]
    store.import_history(made[0], versions(spark, rng, made[0], made[1], day), day)


def load_blacklist(spark, store, rng, day):
    rows = [(f"p{rng.randrange(4)}", day - timedelta(hours=rng.randrange(48))) for _ in range(rng.randrange(3))]
    frame = spark.createDataFrame(rows, schemas.BLACKLIST_DDL)
    store.append_fact(schemas.FACT_BLACKLIST, frame, load_date=day, event="entry_dt")


@pytest.mark.parametrize("seed", [1, 2])
def test_refreshed_equals_full_after_random_loads(spark, tmp_path, seed):
    rng = random.Random(seed)
    store = Store(spark, str(tmp_path))
    incremental = IncrementalReport(store)
    for which in ("cards", "accounts", "clients", "terminals"):
        load_dimension(spark, store, rng, which, DAY)
    load_blacklist(spark, store, rng, DAY)
    store.append_fact(schemas.FACT_TRANSACTIONS, facts(spark, rng, DAY), load_date=DAY, event="trans_date")
    sizes = []
    for step in range(1, 4):
        incremental.refresh()
        assert bag(incremental.report(REPORT_DT)) == bag(full(store)), step
        sizes.append(incremental.report(REPORT_DT).count())
        day = DAY + timedelta(days=step)
        for which in rng.sample(["cards", "accounts", "clients", "terminals"], rng.choice([0, 1, 2])):
            load_dimension(spark, store, rng, which, day)
        if rng.random() < 0.5:
            load_blacklist(spark, store, rng, day)
        again = rng.choice([day, day, DAY])  # a new day, or the first one anew
        store.append_fact(schemas.FACT_TRANSACTIONS, facts(spark, rng, again, rng.choice([0, 40, 40])), load_date=again, event="trans_date")
    incremental.refresh()
    assert bag(incremental.report(REPORT_DT)) == bag(full(store))
    assert max(sizes) > 10


def test_facts_in_order_read_their_day_and_the_one_before(spark, tmp_path):
    rng = random.Random(3)
    store = Store(spark, str(tmp_path))
    incremental = IncrementalReport(store)
    for which in ("cards", "accounts", "clients", "terminals"):
        load_dimension(spark, store, rng, which, DAY)
    load_blacklist(spark, store, rng, DAY)
    for n in range(4):
        day = DAY + timedelta(days=n)
        rows = facts(spark, rng, day, 30).withColumn("trans_date", F.greatest("trans_date", F.lit(f"{day}").cast("timestamp_ntz")))
        store.append_fact(schemas.FACT_TRANSACTIONS, rows, load_date=day, event="trans_date")
        done = incremental.refresh()
        name = f"{day:%Y-%m-%d}"
        assert name in done.whole_days and set(done.whole_days) <= {name, f"{day + timedelta(days=1):%Y-%m-%d}"}
        assert done.part_days == ()
        assert set(done.loads) <= {name, f"{day - timedelta(days=1):%Y-%m-%d}"}
    # Only the partitions of those loads are read: the visible ones prune the scan.
    plan = incremental._facts({schemas.FACT_TRANSACTIONS: 4}, F.col("load").isin(list(done.loads)))
    assert "dynamicpruning" in plan._jdf.queryExecution().executedPlan().toString()
    assert incremental.refresh().loads == ()  # nothing new, nothing read
    assert bag(incremental.report(REPORT_DT)) == bag(full(store))


def test_refreshes_that_overlap(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    store = Store(spark, str(tmp_path))
    for which in ("cards", "accounts", "clients", "terminals"):
        load_dimension(spark, store, rng, which, DAY)
    store.append_fact(schemas.FACT_TRANSACTIONS, facts(spark, rng, DAY), load_date=DAY, event="trans_date")
    one, two, met = IncrementalReport(store), IncrementalReport(Store(spark, str(tmp_path))), []
    own = store.commit

    def meanwhile(*args, **options):
        if not met:
            met.append(two.refresh().version)
        return own(*args, **options)

    monkeypatch.setattr(store, "commit", meanwhile)
    assert one.refresh().version == 1 and met == [1]
    assert bag(one.report(REPORT_DT)) == bag(full(store))


def test_facts_without_times_are_refused(spark, tmp_path):
    rng = random.Random(5)
    store = Store(spark, str(tmp_path))
    store.append_fact(schemas.FACT_TRANSACTIONS, facts(spark, rng, DAY), load_date=DAY)
    with pytest.raises(ValueError, match="event='trans_date'"):
        IncrementalReport(store).refresh()


def test_changed_spans(spark):
    ddl = "k string, effective_from timestamp_ntz, effective_to timestamp_ntz, v string"
    row = lambda k, a, b, v: (k, ts(a), ts(b), v)
    old = [row("same", "1900-01-01", "9999-12-31", "x"), row("cut", "1900-01-01", "9999-12-31", "x"), row("gone", "2020-01-01", "9999-12-31", "x"), row("null", "1900-01-01", "9999-12-31", None)]
    new = [row("same", "1900-01-01", "9999-12-31", "x"), row("cut", "1900-01-01", "2021-01-01", "x"), row("cut", "2021-01-01 00:00:01", "9999-12-31", "y"), row("new", "2021-01-01", "2021-02-01", "z")]
    got = changed_spans(spark.createDataFrame(old, ddl), spark.createDataFrame(new, ddl), key="k", attrs=["v"])
    assert sorted((r.k, str(r.changed_from), str(r.changed_to)) for r in got.collect()) == [
        ("cut", "2021-01-01 00:00:01", "9999-12-31 00:00:00"),
        ("gone", "2020-01-01 00:00:00", "9999-12-31 00:00:00"),
        ("new", "2021-01-01 00:00:00", "2021-02-01 00:00:00"),
    ]
