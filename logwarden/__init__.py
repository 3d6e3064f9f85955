"""Security-log analytics as Spark DataFrame jobs."""

from logwarden.plans.pipeline import AnalysisResult, analyze
from logwarden.session import build_session, prepare_session
from logwarden.settings import DetectionSettings, load_settings

__all__ = [
    "AnalysisResult",
    "DetectionSettings",
    "analyze",
    "build_session",
    "load_settings",
    "prepare_session",
]
