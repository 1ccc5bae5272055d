"""Queries over the payment ledger.

The checks state the definitions: a relation with both sides of every payment, and filtered
aggregates over it.
"""

from opsloom.operators import accounts
from opsloom.plans.catalogue import Tables, query, rounded


def _pick(out: str, back: str) -> str:
    return f"CASE WHEN outgoing THEN {out} ELSE {back} END"


_OWN = _pick("concat(from_bank, '_', from_account)", "concat(to_bank, '_', to_account)")
_OTHER = _pick("concat(to_bank, '_', to_account)", "concat(from_bank, '_', from_account)")
SIDES = f"""both_sides AS (SELECT {_OWN} AS account_key, {_OTHER} AS other, outgoing, CAST(ts AS DATE) AS day, is_laundering, payment_format,
  {_pick('amount_paid', 'amount_received')} AS amount, {_pick('payment_currency', 'receiving_currency')} AS currency, {_pick('to_bank', 'from_bank')} AS other_bank
  FROM v_transactions, (SELECT unnest([true, false]) AS outgoing)),
marked AS (SELECT *, count(*) OVER (PARTITION BY account_key, outgoing, day) AS on_day,
  bool_or(outgoing) OVER pair AND bool_or(NOT outgoing) OVER pair AS mutual FROM both_sides WINDOW pair AS (PARTITION BY account_key, other))"""
MEASURES = {
    "count": "count(*) {f}", "total": "CAST(sum(CAST(amount AS DECIMAL(24,6))) {f} AS DOUBLE)",
    "mean": "CAST(sum(CAST(amount AS DECIMAL(24,6))) {f} AS DOUBLE) / nullif(count(*) {f}, 0)", "max": "max(amount) {f}",
    "currencies": "count(DISTINCT currency) {f}", "banks": "count(DISTINCT other_bank) {f}", "counterparties": "count(DISTINCT other) {f}",
    "formats": "count(DISTINCT payment_format) {f}", "label": "max(is_laundering) {f}"}
MONEY = ("total", "mean", "max")
SENT = [f"sent_{m}" for m in MEASURES]
RECEIVED = [f"received_{m}" for m in MEASURES if m != "formats"]


def _measure(column: str) -> str:
    side, _, measure = column.partition("_")
    return MEASURES[measure].format(f=f"FILTER (WHERE {'outgoing' if side == 'sent' else 'NOT outgoing'})")


PROFILE = f"""WITH {SIDES}, profile AS (SELECT account_key, {", ".join(f"{_measure(c)} AS {c}" for c in SENT + RECEIVED)},
  max(on_day) FILTER (WHERE outgoing) AS max_daily_sent, count(DISTINCT other) FILTER (WHERE mutual) AS reciprocal_counterparties
  FROM marked GROUP BY account_key)"""


def _shown(column: str, fill: bool) -> str:
    value = f"coalesce({column}, 0)" if fill else column
    return f"r4({value}) AS {column}" if column.endswith(MONEY) else f"{value} AS {column}"


def _columns(names, fill: bool = False) -> str:
    return ", ".join(_shown(c, fill) for c in names)


@query("account_sent", f"{PROFILE} SELECT account_key, {_columns(SENT)} FROM profile WHERE sent_count > 0")
def _(t: Tables):
    return rounded(accounts.account_sent(t.once("v_transactions")))


@query("account_received", f"{PROFILE} SELECT account_key, {_columns(RECEIVED)} FROM profile WHERE received_count > 0")
def _(t: Tables):
    return rounded(accounts.account_received(t.once("v_transactions")))


@query("account_velocity", f"{PROFILE} SELECT account_key, max_daily_sent FROM profile WHERE sent_count > 0")
def _(t: Tables):
    return accounts.account_velocity(t.once("v_transactions"))


@query("pair_intersection", f"WITH {SIDES} SELECT DISTINCT account_key, other AS counterparty_key FROM marked WHERE mutual")
def _(t: Tables):
    return accounts.pair_intersection(t.view("v_transactions"))


@query("reciprocal_pairs", f"{PROFILE} SELECT account_key, reciprocal_counterparties FROM profile WHERE reciprocal_counterparties > 0")
def _(t: Tables):
    return accounts.reciprocal_pairs(t.view("v_transactions"))


@query("full_outer_features", f"{PROFILE} SELECT account_key, {_columns(SENT + RECEIVED, fill=True)} FROM profile")
def _(t: Tables):
    ledger = t.once("v_transactions")
    return rounded(accounts.full_outer_features(accounts.account_sent(ledger), accounts.account_received(ledger)))


RATIOS = {"received_sent_ratio": "coalesce(received_total, 0) / nullif(sent_total, 0)",
          "reciprocity_ratio": "reciprocal_counterparties::DOUBLE / nullif(sent_counterparties + received_counterparties, 0)"}
FEATURES_SQL = f"""{PROFILE} SELECT account_key, {_columns([c for c in accounts.FEATURES if c not in RATIOS], fill=True)},
  {", ".join(f"r4({sql}) AS {name}" for name, sql in RATIOS.items())}, greatest(coalesce(sent_label, 0), coalesce(received_label, 0)) AS label FROM profile"""


@query("account_features", FEATURES_SQL)
def _(t: Tables):
    return rounded(accounts.account_features(t.once("v_transactions")))


@query("fill_null_inf", f"""
SELECT account_key, {", ".join(f"r4(coalesce({c}, 0)) AS {c}" for c in accounts.FEATURES)}, label
FROM ({FEATURES_SQL})""")
def _(t: Tables):
    return rounded(accounts.fill_null_inf(accounts.account_features(t.once("v_transactions"))))
