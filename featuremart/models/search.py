"""Adaptive parameter search by successive halving.

All settings are first fitted on a small share of the training rows; the best
``1 / eta`` of them go on to a share ``eta`` times as large, until those left
are fitted on all rows. A share is taken by a hash of the row id, so shares are
nested and the same on every run, and all settings of a round see the same
rows. Scores come from one validation set that no round fits on.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.session import stored

BUCKETS = 1 << 20


@dataclass(frozen=True)
class Trial:
    """One fit: round, share of the rows, number of the setting, its score, and
    whether it goes on (in the last round: whether it is the best)."""

    round: int
    share: float
    setting: int
    score: float
    kept: bool


def share_of_rows(rows: DataFrame, id_col: str, share: float) -> DataFrame:
    """The rows whose hashed id lies in the first ``share`` of the hash range."""
    return rows.where(F.pmod(F.xxhash64(id_col), F.lit(BUCKETS)) < F.lit(math.ceil(share * BUCKETS)))


def shares(settings: int, eta: int) -> list[float]:
    """Growing shares of the rows, the last one 1: one round per division of the
    settings by ``eta``."""
    rounds = 1
    while eta**rounds < settings:
        rounds += 1
    return [1.0 / eta ** (rounds - k) for k in range(rounds + 1)] if settings > 1 else [1.0]


def successive_halving(
    train: DataFrame,
    validation: DataFrame,
    id_col: str,
    settings: Sequence[Mapping],
    score: Callable[[DataFrame, DataFrame, Mapping], float],
    eta: int = 3,
    parallelism: int = 2,
) -> tuple[Mapping, list[Trial]]:
    """The best setting and all trials. ``score(rows, validation, setting)`` fits on
    the rows and judges on the validation rows, larger is better; ties go to
    the setting listed first. Both tables are stored once."""
    if not settings:
        raise ValueError("no settings to search")
    train, validation = stored(train, "search-train"), stored(validation, "search-validation")
    alive, trials = list(range(len(settings))), []
    for number, share in enumerate(shares(len(settings), eta)):
        rows = share_of_rows(train, id_col, share)
        with ThreadPool(min(parallelism, len(alive))) as pool:
            scores = pool.map(lambda k: score(rows, validation, settings[k]), alive)
        order = sorted(range(len(alive)), key=lambda i: (-scores[i], alive[i]))
        last = share == 1.0
        keep = {alive[i] for i in order[: 1 if last else max(1, math.ceil(len(alive) / eta))]}
        trials += [Trial(number, share, k, scores[i], k in keep) for i, k in enumerate(alive)]
        alive = [k for k in alive if k in keep]
    return settings[alive[0]], trials


def row_fits(trials: Sequence[Trial]) -> float:
    """Total work of a search in fits over all rows."""
    return sum(t.share for t in trials)
