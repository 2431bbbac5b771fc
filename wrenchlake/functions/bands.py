"""Band labels; a value outside every band gets ``NA``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wrenchlake.functions import fixed_values as fixed


def _ladder(value: Column, bands: list[tuple[int, str]], above: str) -> Column:
    first_bound, first_label = bands[0]
    label = F.when(value.between(0, first_bound), F.lit(first_label))
    for (low, _), (high, name) in zip(bands, bands[1:]):
        label = label.when((value > low) & (value <= high), F.lit(name))
    return label.when(value > bands[-1][0], F.lit(above)).otherwise(F.lit(fixed.UNKNOWN))


def known_kilometers(kms: Column) -> Column:
    """Odometer reading with -1 for an unknown one."""
    return F.coalesce(kms.cast("bigint"), F.lit(-1).cast("bigint"))


def kms_group(kms: Column) -> Column:
    return _ladder(kms, fixed.KMS_BANDS, fixed.KMS_ABOVE)


def vehicle_age(days: Column) -> Column:
    return _ladder(days, fixed.AGE_BANDS, fixed.AGE_ABOVE)


def _schedule(kms: Column, days: Column, table: dict) -> Column:
    # A band holds if either reading falls in it, so the first match decides.
    lows = [None, *table["kms"]], [None, *table["days"]]
    highs = [*table["kms"], None], [*table["days"], None]
    result = None
    for i, label in enumerate(fixed.SERVICE_LABELS):
        tests = []
        for reading, low, high in ((kms, lows[0][i], highs[0][i]), (days, lows[1][i], highs[1][i])):
            test = (reading >= 0) if low is None else (reading > low)
            tests.append(test if high is None else test & (reading <= high))
        hit = tests[0] | tests[1]
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return result.otherwise(F.lit(fixed.UNKNOWN))


def service_schedule(kms: Column, days: Column, model_name: Column) -> Column:
    """Which scheduled services surround the visit; NULL for an unknown model name."""
    upper = F.upper(model_name)
    big_twin = F.lit(False)
    for name in fixed.SERVICE_650["models"]:
        big_twin = big_twin | upper.contains(name)
    return (
        F.when(model_name.isNull(), F.lit(None).cast("string"))
        .when(big_twin, _schedule(kms, days, fixed.SERVICE_650))
        .otherwise(_schedule(kms, days, fixed.SERVICE_OTHER))
    )


def year_bucket(event: Column, mfg_date: Column, years: int, label: str) -> Column:
    """``label`` while the event is within ``years`` of the build date, else ``NA``."""
    return F.when(event <= F.add_months(mfg_date, 12 * years), F.lit(label)).otherwise(F.lit(fixed.UNKNOWN))
