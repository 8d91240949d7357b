"""The fraud report: four rules over transactions and the histories valid at their time.

1. the passport is on the blacklist since before the transaction, or has expired;
2. the account's contract has ended;
3. the card was used in another city at most an hour before;
4. a successful operation right after three rejected ones with falling amounts, all
   within 20 minutes.

Rules 1 and 2 need the holder of the card at the time of each transaction. Cards,
accounts, clients and first blacklist entries are joined among themselves into spans
of time per card; then the transactions are joined once, on the card. Rules 3 and 4
find moments of a card on aggregated rows, and only what they flag is joined. The full
report sends both through the same single join.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.columns import explode_present, full_name, past_last_day
from vaultline.operators.asof import asof_dim_join, overlay
from vaultline.operators.blacklist import entry_counts
from vaultline.operators.moments import (
    DAY,
    HOUR,
    attempt_facts,
    in_slots,
    place_facts,
    with_decreasing_chain,
    with_two_places,
)
from vaultline.schemas import REPORT_COLUMNS, SPENDING_TYPES, ntz

PASSPORT, CONTRACT, CITIES, GUESSING = 1, 2, 3, 4

ACCOUNT_ATTRS = {"client": "client_id", "valid_to": "account_valid_to"}
CLIENT_ATTRS = (
    "last_name",
    "first_name",
    "patronymic",
    "passport_num",
    "passport_valid_to",
    "phone",
)


def holder_spans(
    cards: DataFrame, accounts: DataFrame, clients: DataFrame, blacklist: DataFrame | None = None
) -> DataFrame:
    """Per card and span of time: the account's end, the client and the passport.

    ``card_num, effective_from, effective_to, account_num, client_id, account_valid_to``
    and the client's attributes; with ``blacklist`` also ``entries``, how many entries the
    passport has had before the span, NULL if none.
    """
    spans = cards.filter((F.col("deleted_flg") == "N") & F.col("card_num").isNotNull()).select(
        "card_num", "account_num", "effective_from", "effective_to"
    )
    spans = overlay(
        spans, accounts, base_key="account_num", dim_key="account_num", attrs=ACCOUNT_ATTRS
    )
    spans = overlay(spans, clients, base_key="client_id", dim_key="client_id", attrs=CLIENT_ATTRS)
    if blacklist is not None:
        listed = entry_counts(blacklist).select(
            "passport_num",
            "entries",
            F.col("listed_from").alias("effective_from"),
            F.col("listed_to").alias("effective_to"),
            F.lit("N").alias("deleted_flg"),
        )
        spans = overlay(spans, listed, base_key="passport_num", dim_key="passport_num", attrs=["entries"])
    return spans


def suspects(spans: DataFrame, latest: Column) -> DataFrame:
    """The spans in which rule 1 or 2 can hold for a transaction up to ``latest``.

    Few holders have run into trouble by then, so this is a small part of the spans, often
    small enough to broadcast. ``spans`` must have been built with the blacklist.
    """
    trouble = F.least(
        F.col("passport_valid_to") + F.make_dt_interval(days=F.lit(1)),
        F.col("account_valid_to") + F.make_dt_interval(days=F.lit(1)),
    )
    listed = F.col("entries").isNotNull() & (F.col("effective_from") <= latest)
    return spans.filter(listed | (trouble < F.least(F.col("effective_to"), latest)))


def at_time(
    tx: DataFrame,
    spans: DataFrame,
    *,
    key: str = "card_num",
    ts: str = "trans_date",
    how: str = "left",
) -> DataFrame:
    """Transactions with the holder of their card at their time; NULLs if there is none."""
    attrs = [name for name in spans.columns if name not in (key, "effective_from", "effective_to")]
    holders = spans.select(
        F.col(key).alias("_span_card"),
        F.col("effective_from").alias("_span_from"),
        F.col("effective_to").alias("_span_to"),
        *attrs,
    )
    held = (tx[key] == F.col("_span_card")) & tx[ts].between(F.col("_span_from"), F.col("_span_to"))
    return tx.join(holders, held, how).drop("_span_card", "_span_from", "_span_to")


def asof_chain(tx: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame) -> DataFrame:
    """Each transaction with card, account and client versions valid at its time."""
    return at_time(tx, holder_spans(cards, accounts, clients))


def with_city_codes(terminals: DataFrame) -> DataFrame:
    """Add ``city_code``, a number that stands for the city.

    Extremes of numbers are aggregated in generated code on a hash table, those of text
    only by sorting. Should two cities ever get one code, the job fails.
    """
    coded = terminals.select(
        "*", F.when(F.col("terminal_city").isNotNull(), F.xxhash64("terminal_city")).alias("city_code")
    )
    cities = coded.select("terminal_city", "city_code").distinct().groupBy("city_code").count()
    clash = cities.agg(F.max("count")).scalar() > 1
    return coded.filter(
        F.when(clash, F.raise_error(F.lit("two cities with one code"))).otherwise(F.lit(True))
    )


def locate(tx: DataFrame, terminals: DataFrame) -> DataFrame:
    """Add the city (and its code) of the terminal at the time of the transaction."""
    return asof_dim_join(
        tx,
        with_city_codes(terminals),
        fact_key="terminal",
        dim_key="terminal_id",
        ts="trans_date",
        attrs={"terminal_city": "city", "city_code": "city_code"},
    )


def _repeat(rows: DataFrame, copies: str) -> DataFrame:
    """Each row ``copies`` times. In two steps, so no row ever holds a long array, and a row
    with very many copies is spread over tasks in between."""
    step = 1_000
    count = F.col(copies)
    return (
        rows.withColumn("_block", F.explode(F.sequence(F.lit(1), F.ceil(count / step))))
        .hint("rebalance")
        .withColumn(
            "_copy",
            F.explode(
                F.sequence(F.lit(1), F.least(F.lit(step), count - (F.col("_block") - 1) * step))
            ),
        )
        .drop("_block", "_copy")
    )


def _report_rows(
    rows: DataFrame, event_type: Column | int, report_dt: datetime | str, keep: Sequence[str] = ()
) -> DataFrame:
    kind = F.lit(event_type) if isinstance(event_type, int) else event_type
    return rows.select(
        *keep,
        F.col("trans_date").alias("event_dt"),
        F.col("passport_num").alias("passport"),
        full_name("last_name", "first_name", "patronymic").alias("fio"),
        "phone",
        kind.cast("smallint").alias("event_type"),
        ntz(report_dt).alias("report_dt"),
    )


# NULL if a time is missing. A filter drops that like false, and then Spark can see that
# rows without a holder never pass and plan an inner join.


def _listed() -> Column:
    return F.col("entries").isNotNull()


def _expired() -> Column:
    return past_last_day("passport_valid_to", "trans_date")


def _contract_ended() -> Column:
    return past_last_day("account_valid_to", "trans_date")


def fraud_passport(
    tx: DataFrame,
    cards: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    blacklist: DataFrame,
    *,
    report_dt: datetime | str,
    dedupe: bool = False,
) -> DataFrame:
    """Rule 1. A listed passport gives one row per earlier entry, or one with ``dedupe``."""
    spans = holder_spans(cards, accounts, clients, blacklist)
    flagged = at_time(tx.select("trans_date", "card_num"), spans).filter(_listed() | _expired())
    if not dedupe:
        flagged = _repeat(flagged.withColumn("copies", F.coalesce("entries", F.lit(1))), "copies")
    return _report_rows(flagged, PASSPORT, report_dt)


def fraud_contract(
    tx: DataFrame,
    cards: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    *,
    report_dt: datetime | str,
) -> DataFrame:
    """Rule 2. The client is optional: a row without one has NULL passport and phone."""
    held = at_time(tx.select("trans_date", "card_num"), holder_spans(cards, accounts, clients))
    return _report_rows(held.filter(_contract_ended()), CONTRACT, report_dt)


def _flagged_moments(
    tx: DataFrame,
    terminals: DataFrame | None,
    *,
    guessing: bool,
    city_within: int = HOUR,
    chain: int = 3,
    chain_within: int = 1_200,
    types: Sequence[str] = SPENDING_TYPES,
) -> DataFrame:
    """``card_num, trans_date, event_type, copies`` of what rules 3 and 4 flag."""
    facts: list[Column] = []
    if terminals is not None:
        tx = locate(tx, terminals)
        facts += place_facts("city_code")
    if guessing:
        facts += attempt_facts(
            tie="trans_id", amount="amt", oper_type="oper_type", oper_result="oper_result", types=types
        )
    reach = max(city_within if terminals is not None else 0, chain_within if guessing else 0)
    moments = in_slots(
        tx.groupBy("card_num", "trans_date").agg(*facts), ts="trans_date", reach=reach, width=DAY
    )
    hits: list[Column] = []
    if terminals is not None:
        moments = with_two_places(moments, key="card_num", ts="trans_date", within=city_within)
        hits.append(
            F.when(
                F.col("two_places"),
                F.struct(F.lit(CITIES).alias("event_type"), F.col("_placed").alias("copies")),
            )
        )
    if guessing:
        moments = with_decreasing_chain(
            moments, key="card_num", ts="trans_date", n=chain, within=chain_within
        )
        hits.append(
            F.when(
                F.col("chain_end"),
                F.struct(F.lit(GUESSING).alias("event_type"), F.lit(1).cast("bigint").alias("copies")),
            )
        )
    return explode_present(moments.filter("_home"), "_hit", *hits).select(
        "card_num", "trans_date", "_hit.*"
    )


def fraud_cities(
    tx: DataFrame,
    cards: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    terminals: DataFrame,
    *,
    report_dt: datetime | str,
    within: int = HOUR,
) -> DataFrame:
    """Rule 3. Operations of one card in the same second with two cities are all reported."""
    flagged = _flagged_moments(tx, terminals, guessing=False, city_within=within)
    held = at_time(flagged, holder_spans(cards, accounts, clients))
    return _report_rows(_repeat(held, "copies"), CITIES, report_dt)


def fraud_guessing(
    tx: DataFrame,
    cards: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    *,
    report_dt: datetime | str,
    n: int = 3,
    within: int = 1_200,
    types: Sequence[str] = SPENDING_TYPES,
) -> DataFrame:
    """Rule 4. Holder and client are optional."""
    flagged = _flagged_moments(
        tx, None, guessing=True, chain=n, chain_within=within, types=types
    )
    held = at_time(flagged, holder_spans(cards, accounts, clients))
    return _report_rows(held, GUESSING, report_dt)


def _all_rules(
    tx: DataFrame,
    terminals: DataFrame,
    spans: DataFrame,
    suspect_spans: DataFrame | None,
    *,
    n: int,
    within: int,
) -> DataFrame:
    """One row per transaction (or moment) and rule, with ``event_type`` and ``copies``."""
    flagged = _flagged_moments(
        tx, terminals, guessing=True, chain=n, chain_within=within
    ).withColumnRenamed("event_type", "moment_type")
    plain = tx.filter(F.col("card_num").isNotNull()).select(
        "card_num",
        "trans_date",
        F.lit(None).cast("int").alias("moment_type"),
        F.lit(1).cast("bigint").alias("copies"),
    )
    if suspect_spans is None:
        held = at_time(plain.unionByName(flagged), spans)
    else:
        held = at_time(plain, suspect_spans, how="inner").unionByName(at_time(flagged, spans))
    of_moment = F.col("moment_type").isNotNull()
    passport = ~of_moment & (_listed() | _expired())
    contract = ~of_moment & _contract_ended()
    return explode_present(
        held.filter(of_moment | passport | contract),
        "event_type",
        F.when(passport, PASSPORT),
        F.when(contract, CONTRACT),
        F.col("moment_type"),
    )


def report_from_spans(
    tx: DataFrame,
    terminals: DataFrame,
    spans: DataFrame,
    suspect_spans: DataFrame | None = None,
    *,
    report_dt: datetime | str,
    n: int = 3,
    within: int = 1_200,
    dedupe: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """All four rules over holder spans. ``keep`` names columns of the holder to add, such as the card.

    With ``suspect_spans`` (see ``suspects``) rules 1 and 2 read only these. If they are
    a stored table, Spark knows their size when it plans, and if that allows a broadcast
    the transactions are not shuffled for these rules at all.
    """
    hits = _all_rules(tx, terminals, spans, suspect_spans, n=n, within=within)
    if not dedupe:
        by_entry = F.when(F.col("event_type") == PASSPORT, F.col("entries"))
        hits = hits.withColumn("copies", F.coalesce(by_entry, "copies"))
    return _report_rows(_repeat(hits, "copies"), F.col("event_type"), report_dt, keep)


def fraud_report(
    tx: DataFrame,
    cards: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    terminals: DataFrame,
    blacklist: DataFrame,
    *,
    report_dt: datetime | str,
    n: int = 3,
    within: int = 1_200,
) -> DataFrame:
    """All four rules. Same rows as the union of the four, from one join to the holders."""
    spans = holder_spans(cards, accounts, clients, blacklist)
    return report_from_spans(
        tx, terminals, spans, report_dt=report_dt, n=n, within=within
    )


def fraud_combined(
    tx: DataFrame,
    cards: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    terminals: DataFrame,
    blacklist: DataFrame,
    *,
    report_dt: datetime | str,
    n: int = 3,
    within: int = 1_200,
) -> DataFrame:
    """One row per transaction and rule: repeated blacklist entries do not repeat rows."""
    spans = holder_spans(cards, accounts, clients, blacklist)
    return report_from_spans(
        tx, terminals, spans, report_dt=report_dt, n=n, within=within, dedupe=True
    )


def report_union(*rules: DataFrame) -> DataFrame:
    """Rule results as one report, repeats kept."""
    report = rules[0].select(*REPORT_COLUMNS)
    for rule in rules[1:]:
        report = report.unionByName(rule.select(*REPORT_COLUMNS))
    return report
