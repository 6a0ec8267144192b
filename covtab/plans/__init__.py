"""Wiring of the operators into the published report, publishing, and checks."""

from covtab.plans.job import run_job
from covtab.plans.report import Report, build_report
from covtab.plans.views import register_views

__all__ = ["Report", "build_report", "register_views", "run_job"]
