"""Folder layout of a deployment, by stage and run date."""

from __future__ import annotations

# Stage folders.
STAGES = {
    "config": "00_pipeline_config",
    "incidents": "01_incidents_detected",
    "imagery": "02_satellite_imagery",
    "predictions": "02_prediction_jobs",
    "reports": "03_final_reports",
}


def stage_path(root: str, stage: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), STAGES[stage], *parts])
