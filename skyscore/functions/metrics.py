"""Verification metrics as Spark Column builders.

A metric is described by the *partial aggregates* it needs and a *final*
expression over those partials. :func:`skyscore.operators.stats.compute_statistics`
collects the partials of every requested metric, de-duplicates them by name
and evaluates all metrics for all groups in one ``groupBy().agg()`` (plus one
small pre-aggregate for the group means when a metric is centred on the
observed mean). Everything stays inside Catalyst / whole-stage codegen; no
Python runs per row.

Conventions: ``o`` observation, ``m`` model, ``d = m - o``, ``w`` weight,
``ob`` / ``mb`` the group means of ``o`` / ``m`` (weighted means when weights
are in use), ``c`` the climatology for the anomaly correlation (defaults to
``ob``). Inputs reaching the aggregates are already pairwise valid (F7).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numerics import clip, safe_div

log = logging.getLogger(__name__)


@dataclass
class Ctx:
    o: Column
    m: Column
    w: Column | None = None
    ob: Column | None = None
    mb: Column | None = None
    c: Column | None = None

    @property
    def d(self) -> Column:
        return self.m - self.o


A = Callable[[str], Column]  # partial-name -> column of the aggregated frame


@dataclass
class Metric:
    name: str
    aggs: Callable[[Ctx], dict]
    final: Callable[[A], Column]
    centred: bool = False
    waggs: Callable[[Ctx], dict] | None = None
    wfinal: Callable[[A], Column] | None = None
    wcentred: bool = False
    doc: str = ""
    aliases: tuple = field(default_factory=tuple)
    dtype: str = "double"


def _n(x: Ctx) -> dict:
    return {"_n": F.count(F.lit(1))}


def _sw(x: Ctx) -> dict:
    return {"_sw": F.sum(x.w)}


def _moments(x: Ctx) -> dict:
    return {"_n": F.count(F.lit(1)), "_mo": F.avg(x.o), "_mm": F.avg(x.m),
            "_sdo": F.stddev_samp(x.o), "_sdm": F.stddev_samp(x.m),
            "_cov": F.covar_samp(x.o, x.m)}


def _pearson(a: A) -> Column:
    ok = (a("_n") >= 2) & (a("_sdo") > 0) & (a("_sdm") > 0)
    return F.when(ok, a("_cov") / (a("_sdo") * a("_sdm")))


def _wpearson_aggs(x: Ctx) -> dict:
    # weighted covariance / variances around the weighted means (centred
    # first, so no cancellation of large raw moments)
    return {"_n": F.count(F.lit(1)),
            "_swoo": F.sum(x.w * (x.o - x.ob) * (x.o - x.ob)),
            "_swmm": F.sum(x.w * (x.m - x.mb) * (x.m - x.mb)),
            "_swom": F.sum(x.w * (x.o - x.ob) * (x.m - x.mb))}


def _wpearson(a: A) -> Column:
    ok = (a("_n") >= 2) & (a("_swoo") > 0) & (a("_swmm") > 0)
    return F.when(ok, a("_swom") / F.sqrt(a("_swoo") * a("_swmm")))


def _degenerate(a: A) -> Column:
    """Fewer than two pairs or a constant series -> no value."""
    return (a("_n") < 2) | (a("_sdo") == 0) | (a("_sdm") == 0) | a("_sdo").isNull() | a("_sdm").isNull()


def _kge(a: A) -> Column:
    r = a("_cov") / (a("_sdo") * a("_sdm"))
    alpha = a("_sdm") / a("_sdo")
    beta = safe_div(a("_mm"), a("_mo"))
    val = 1 - F.sqrt((r - 1) ** 2 + (alpha - 1) ** 2 + (beta - 1) ** 2)
    return F.when(~_degenerate(a) & (a("_mo") != 0), val)


def _ccc(a: A) -> Column:
    den = a("_sdo") ** 2 + a("_sdm") ** 2 + (a("_mo") - a("_mm")) ** 2
    val = clip(safe_div(2 * a("_cov"), den), -1.0, 1.0)
    return F.when(~_degenerate(a), val)


def _ioa_radar_aggs(x: Ctx) -> dict:
    return {**_moments(x), "_sdd": F.sum(x.d * x.d),
            "_spe": F.sum((F.abs(x.m - x.ob) + F.abs(x.o - x.ob)) ** 2)}


def _ioa_radar(a: A) -> Column:
    val = clip(1 - safe_div(a("_sdd"), a("_spe")), 0.0, 1.0)
    return F.when(~_degenerate(a) & (a("_spe") != 0), val)


def _mape_aggs(x: Ctx) -> dict:
    return {"_nzero": F.max(F.when(x.o == 0, 1).otherwise(0)),
            "_ape": F.avg(F.abs(x.d) / F.abs(F.when(x.o != 0, x.o)))}


def _mape(a: A) -> Column:
    # any zero observation makes the mean of |d|/|o| infinite
    return F.when(a("_nzero") == 1, F.lit(float("inf"))).otherwise(100.0 * a("_ape"))


def _wmean(expr: Callable[[Ctx], Column], key: str):
    return lambda x: {"_sw": F.sum(x.w), key: F.sum(x.w * expr(x))}


_SQ = lambda x: x.d * x.d
_AB = lambda x: F.abs(x.d)
_D = lambda x: x.d


METRICS: dict[str, Metric] = {}


def register(metric: Metric) -> Metric:
    """Add a metric (user extension point, M23)."""
    METRICS[metric.name.lower()] = metric
    for al in metric.aliases:
        ALIASES[al.lower()] = metric.name.lower()
    return metric


# --- fixed values: metric names and aliases accepted by the statistics step ---
ALIASES: dict[str, str] = {
    "bias": "mb", "mbias": "mb", "mean_bias": "mb",
    "r": "corr", "correlation": "corr", "pearsonr": "corr", "pearson": "corr",
    "ioa": "ioa_radar", "wasserstein": "wassersteindistance",
}

register(Metric("n", _n, lambda a: a("_n"), doc="number of valid pairs", dtype="bigint"))
register(Metric("mean_obs", lambda x: {"_mo": F.avg(x.o)}, lambda a: a("_mo"),
                waggs=_wmean(lambda x: x.o, "_swo"), wfinal=lambda a: safe_div(a("_swo"), a("_sw")),
                doc="mean observation over the valid pairs"))
register(Metric("mean_mod", lambda x: {"_mm": F.avg(x.m)}, lambda a: a("_mm"),
                waggs=_wmean(lambda x: x.m, "_swm"), wfinal=lambda a: safe_div(a("_swm"), a("_sw")),
                doc="mean model value over the valid pairs"))
register(Metric("rmse", lambda x: {"_msd": F.avg(_SQ(x))}, lambda a: F.sqrt(a("_msd")),
                waggs=_wmean(_SQ, "_swdd"), wfinal=lambda a: F.sqrt(safe_div(a("_swdd"), a("_sw"))),
                doc="root mean square error"))
register(Metric("mse", lambda x: {"_msd": F.avg(_SQ(x))}, lambda a: a("_msd"),
                waggs=_wmean(_SQ, "_swdd"), wfinal=lambda a: safe_div(a("_swdd"), a("_sw")),
                doc="mean square error"))
register(Metric("mb", lambda x: {"_md": F.avg(_D(x))}, lambda a: a("_md"),
                waggs=_wmean(_D, "_swd"), wfinal=lambda a: safe_div(a("_swd"), a("_sw")),
                doc="mean bias m - o"))
register(Metric("mae", lambda x: {"_mad": F.avg(_AB(x))}, lambda a: a("_mad"),
                waggs=_wmean(_AB, "_swad"), wfinal=lambda a: safe_div(a("_swad"), a("_sw")),
                doc="mean absolute error"))
register(Metric("corr", _moments, _pearson, waggs=_wpearson_aggs, wfinal=_wpearson, wcentred=True,
                doc="Pearson correlation, NULL when n < 2 or a series is constant"))
register(Metric("r2", _moments, lambda a: _pearson(a) ** 2,
                waggs=_wpearson_aggs, wfinal=lambda a: _wpearson(a) ** 2, wcentred=True,
                doc="squared Pearson correlation"))
register(Metric("mape", _mape_aggs, _mape,
                doc="100 * mean(|m-o|/|o|); +inf when any observation is 0"))
register(Metric("fac2",
                lambda x: {"_fac2": F.avg(F.when((x.o != 0) & (x.m / F.when(x.o != 0, x.o)).between(0.5, 2.0), 1.0)
                                          .otherwise(0.0))},
                lambda a: a("_fac2"), doc="fraction of pairs with 0.5 <= m/o <= 2"))
register(Metric("ioa_m",
                lambda x: {"_sdd": F.sum(x.d * x.d),
                           "_spe": F.sum((F.abs(x.m - x.ob) + F.abs(x.o - x.ob)) ** 2)},
                lambda a: 1 - safe_div(a("_sdd"), a("_spe")), centred=True,
                doc="Willmott index of agreement"))
register(Metric("d1",
                lambda x: {"_sad": F.sum(F.abs(x.d)),
                           "_spa": F.sum(F.abs(x.m - x.ob) + F.abs(x.o - x.ob))},
                lambda a: 1 - safe_div(a("_sad"), a("_spa")), centred=True,
                doc="modified index of agreement (absolute form)"))
register(Metric("e1",
                lambda x: {"_sad": F.sum(F.abs(x.d)), "_soa": F.sum(F.abs(x.o - x.ob))},
                lambda a: 1 - safe_div(a("_sad"), a("_soa")), centred=True,
                doc="modified coefficient of efficiency (Legates & McCabe)"))
register(Metric("ac",
                lambda x: {"_sac": F.sum((x.m - x.c) * (x.o - x.c)),
                           "_smc": F.sum((x.m - x.c) ** 2), "_soc": F.sum((x.o - x.c) ** 2)},
                lambda a: safe_div(a("_sac"), F.sqrt(a("_smc") * a("_soc"))), centred=True,
                doc="anomaly correlation about climatology c (default: group obs mean)"))
register(Metric("ioa_radar", _ioa_radar_aggs, _ioa_radar, centred=True,
                doc="index of agreement clipped to [0,1], NULL when degenerate"))
register(Metric("kge", _moments, _kge, doc="Kling-Gupta efficiency"))
register(Metric("ccc", _moments, _ccc, doc="Lin concordance correlation, clipped to [-1,1]"))


def resolve(names, skip_unknown: bool = False) -> list[Metric]:
    """Alias, then exact (case-insensitive) lookup. Unknown names raise
    unless ``skip_unknown`` (then they are skipped with a warning)."""
    out, seen = [], set()
    for raw in names:
        key = ALIASES.get(raw.lower(), raw.lower())
        met = METRICS.get(key)
        if met is None:
            if skip_unknown:
                log.warning("metric %r not found, skipped", raw)
                continue
            raise ValueError(f"unknown metric {raw!r}")
        if key not in seen:
            seen.add(key)
            out.append((raw, met))
    return out
