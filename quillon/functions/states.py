"""Mappings between remote outcomes and local states."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quillon.config import JOB_STATES, TERMINAL_JOB_STATES

# HTTP statuses that mean the resource is gone for good.
GONE_CODES = (404, 410)
TRANSIENT_ERRORS = ("timeout", "network", "protocol")


def local_state(job_state: Column) -> Column:
    """Local batch state of a remote job state; unknown states count as running."""
    pairs = [F.lit(x) for item in JOB_STATES.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), job_state), F.lit("RUNNING"))


def is_terminal(job_state: Column) -> Column:
    return F.coalesce(job_state.isin(*TERMINAL_JOB_STATES), F.lit(False))


def fetch_status(status_code: Column, error_kind: Column) -> Column:
    """Final image status of one fetch."""
    gone = F.coalesce(status_code.isin(*GONE_CODES), F.lit(False))
    fine = F.coalesce(status_code.between(200, 299), F.lit(False)) & error_kind.isNull()
    return F.when(gone, "failed_404").when(fine, "ok").otherwise("failed_other")


def should_retry(status_code: Column, error_kind: Column, attempt: Column, attempts: int) -> Column:
    """Whether another try follows: any HTTP error but 'gone', or a connection error."""
    http_error = (status_code >= 400) & ~status_code.isin(*GONE_CODES)
    connection = error_kind.isin(*TRANSIENT_ERRORS)
    transient = F.coalesce(http_error, F.lit(False)) | F.coalesce(connection, F.lit(False))
    return transient & (attempt < attempts)
