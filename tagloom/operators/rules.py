"""The daily rule run: all tags against the stored tag rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import codes as C
from tagloom.functions.codes import KEYS
from tagloom.operators import tags as T
from tagloom.operators.merge import update
from tagloom.operators.profile import rule_tags
from tagloom.operators.warehouse import ODS_KEY, apply_tag_batch, refresh_wide

# tags whose stored rows stay enabled until replaced
NOT_RESET = [C.CHURNED, C.REPEAT_DEPOSIT, C.APP_USER, C.LOGIN_UB, C.LOGIN_PC]


@dataclass
class RuleInputs:
    members: DataFrame
    login: DataFrame
    login_raw: DataFrame
    deposits: DataFrame
    ga_page: DataFrame
    edits: DataFrame
    opcode_types: DataFrame
    bets15: DataFrame
    deposits15: DataFrame
    bet_time15: DataFrame
    cash15: DataFrame
    arbitrage: DataFrame | None = None  # hedged rounds; without them the run sets no hedge tags
    stored_tags: DataFrame | None = None


@dataclass
class RuleSettings:
    as_of: date
    today: date
    now: datetime
    good_customer_deposit: int
    avg_deposit_bands: dict = field(default_factory=lambda: C.AVG_DEPOSIT_BANDS)
    max_bet_bands: dict = field(default_factory=lambda: C.MAX_BET_BANDS)
    turnover_drop_bands: dict = field(default_factory=lambda: C.TURNOVER_DROP_BANDS)


def run_tag_rules(ods: DataFrame, inputs: RuleInputs, settings: RuleSettings) -> DataFrame:
    """Stored tags after the run: rules, then manual edits, then good/bad conflicts.

    Reset and replacement are one merge; conflicts are found among a member's own
    rows, whose number the tag dictionary bounds.
    """
    reset = [c for c in T.rule_codes() if c not in NOT_RESET]
    merged = apply_tag_batch(ods, rule_tags(inputs, settings), reset, settings.now)
    edited = update(merged, T.tag_manual_edits(inputs.edits, T.rule_codes()), ODS_KEY)
    bad = F.max(F.col("tag_enabled") & F.col("tag_code").isin(C.BAD_CODES)).over(Window.partitionBy(*KEYS))
    conflict = F.col("tag_enabled") & F.col("tag_code").isin(C.GOOD_CODES) & F.coalesce(bad, F.lit(False))
    return edited.withColumn("tag_enabled", F.when(conflict, False).otherwise(F.col("tag_enabled")))


@dataclass
class TagDay:
    ods: DataFrame
    dw: DataFrame


def run_tag_day(
    ods: DataFrame, dw: DataFrame, tag_dim: DataFrame, bets: DataFrame, inputs: RuleInputs, settings: RuleSettings,
    materialise: Callable[[DataFrame], DataFrame],
) -> TagDay:
    """The whole daily job: rules (with hedge tags if ``inputs`` has rounds), and the wide table brought up to date with them."""
    after = materialise(run_tag_rules(ods, inputs, settings))
    return TagDay(after, refresh_wide(after, dw, inputs.members, tag_dim, bets, inputs.login))
