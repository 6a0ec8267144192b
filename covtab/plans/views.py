"""Register the report's stages and tables as temporary views, so SQL users
can query them by name (as the original job's checks queried its views)."""

from __future__ import annotations

from collections.abc import Iterable

from covtab.plans.report import Report


def register_views(report: Report, prefix: str = "covtab_", names: Iterable[str] | None = None) -> list[str]:
    """Create ``{prefix}{name}`` temp views for the published tables
    (``table_1`` ... ``org_reference``), their numeric twins
    (``numeric_table_1`` ...) and the named stages (``population``,
    ``cells_primary``, ``coverage_secondary``, ``quality`` ...).

    ``names`` limits which ones are registered; a stage is only built when
    it is registered. Returns the view names.
    """
    entries = {**{k: ("tables", k) for k in report.tables},
               **{f"numeric_{k}": ("numeric", k) for k in report.numeric},
               **{k: ("stages", k) for k in report.stages}}
    wanted = list(names) if names is not None else list(entries)
    created = []
    for name in wanted:
        group, key = entries[name]
        view = f"{prefix}{name}"
        getattr(report, group)[key].createOrReplaceTempView(view)
        created.append(view)
    return created
