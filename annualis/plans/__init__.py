from annualis.plans.panel import (
    SHARED, STAGES, build_panel, run, run_report, scan_sources, stage_tables,
)

__all__ = ["SHARED", "STAGES", "build_panel", "run", "run_report", "scan_sources", "stage_tables"]
