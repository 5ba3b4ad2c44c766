"""D3: the daily delivery run.

    insert   attribution conversion rows -> ledger (new batch, sftp NULL)
    mark     every NULL batch -> FALSE (in flight)
    export   every in-flight row -> delivery file (skipped when there is none)
    finish   every FALSE batch -> TRUE, only after the export succeeded

A failed export leaves the rows in flight, so the next run exports them
again (at-least-once delivery).  A rerun of the same day inserts nothing
new because the high-water mark has moved (day granularity).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from creditflow.operators.orders import WINDOW_DAYS, Bounds, resolve_bounds
from creditflow.operators.touches import validate_countries
from creditflow.plans.attribution import Attribution
from creditflow.sources import export
from creditflow.sources.identity import IdentityMap
from creditflow.sources.ledger import Ledger, undelivered


@dataclass
class RunReport:
    batch: int
    mark: object
    exported_rows: int


def run_delivery(spark: SparkSession, tables: dict, ledger_root: str, out_path: str,
                 variant: str = "all", window_days: int = WINDOW_DAYS, export_fn=None,
                 bootstrap_mark=None, identity_root: str | None = None) -> RunReport:
    """Run one day of the job against the logical ``tables`` and the ledger at ``ledger_root``.

    ``export_fn(undelivered_df, out_path) -> int`` defaults to
    ``creditflow.sources.export.write_delivery``; an exception from it stops
    the run before the finish step.  ``bootstrap_mark`` is used only while
    the ledger is empty (a cold start would otherwise select nothing).
    The country dimension is validated first (unique name and alpha2).
    ``identity_root`` names a maintained identity map, brought up to date first.
    """
    validate_countries(tables["iso_2_mapping"])
    ledger = Ledger(spark, ledger_root)
    mark = ledger.high_water_mark()
    if mark is None:
        mark = bootstrap_mark
    if mark is None:
        bounds = Bounds(None, None, window_days)
    else:
        bounds = resolve_bounds(ledger.read(), tables["sessions"], window_days, mark=mark)
    people = None
    if identity_root is not None:
        identities = IdentityMap(spark, identity_root)
        identities.update(tables["sessions"])
        people = identities.read()
    run = Attribution(dict(tables, ledger=ledger.read()), bounds=bounds, variant=variant,
                      window_days=window_days, checkpoint=True, people=people)
    batch = ledger.append(run.conversions)          # insert
    ledger.mark_in_flight()                         # mark
    rows = (export_fn or export.write_delivery)(undelivered(ledger.read()), out_path)  # export
    ledger.mark_delivered()                         # finish
    return RunReport(batch=batch, mark=mark, exported_rows=rows)
