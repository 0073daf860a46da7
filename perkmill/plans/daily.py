"""The jobs of one day in order, each on the accounts the one before it left."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from ..functions.lineage import scratch
from ..operators import email_grant
from ..params import Params
from ..sources.store import Store
from . import jobs
from .jobs import JOBS, JobResult

ORDER = ["accrual", "campaign", "order count", "referral", "review", "editor review", "tier upgrade"]


def run_job(
    store: Store,
    job: str,
    run_id: str,
    previous: str,
    inputs: Mapping[str, DataFrame],
    p: Params,
    run: Callable[[Mapping[str, DataFrame], Params], JobResult] | None = None,
) -> None:
    """`run` stands in for the job of that name. What the job wrote on the way is deleted. A run that has
    ended stays as it is, so a day that broke off may be run again from its beginning."""
    if store.is_committed(run_id):
        return
    with scratch(store.spark):
        tables = store.tables(inputs, run_id, previous)
        store.commit(run_id, job, tables, (run or JOBS[job])(tables, p), previous)


def run_email_list(
    store: Store, run_id: str, previous: str, inputs: Mapping[str, DataFrame], p: Params, raw: DataFrame, list_id: str
) -> None:
    """`raw` comes from `sources.email_list`."""
    run_job(store, email_grant.JOB, run_id, previous, inputs, p, lambda t, p: jobs.run_email_list(t, p, raw, list_id))


def run_day(
    store: Store, day: str, previous: str, inputs: Mapping[str, DataFrame], p: Params, jobs: list[str] | None = None
) -> str:
    """Runs `jobs` (all but the on-demand ones if not given), then writes the day's account snapshot;
    returns the last run id."""
    for number, job in enumerate(jobs or ORDER):
        run_id = f"{day}-{number:02d}"
        run_job(store, job, run_id, previous, inputs, p)
        previous = run_id
    store.snapshot(previous)
    return previous
